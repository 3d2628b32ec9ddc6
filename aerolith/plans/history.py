"""Rebuilding old runs: checksums, build, validation, publishing, catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.archive import raw_violations
from ..operators.catalog import definitions, with_init
from ..operators.probability import validate
from ..operators.readiness import INIT, pending
from ..sources.shared import kept
from ..sources.catalog_store import products_of, remove, upsert
from ..sources.products import read_product, write_product


def restore_history(spark: SparkSession, manifests: DataFrame, outputs: DataFrame, listed: DataFrame, hashes: DataFrame, build: Callable[[DataFrame], DataFrame], expected: DataFrame | None, root: str, catalog: str, signatures: DataFrame) -> DataFrame:
    """Build what is pending and publish it; returns the violations that kept runs back.

    Runs with a raw file that differs from its manifest are left out before
    building. With ``expected``, of all runs or, where it has their keys, of each
    by its contract, a product is validated before it is written.
    A run whose product is newer than its manifest is not built again, so a
    restart goes on where the last stopped.
    """
    due = pending(manifests, outputs).filter("action = 'process'").select(*INIT)
    faults = raw_violations(listed.join(due, INIT, "left_semi"), hashes.join(due, INIT, "left_semi"))
    product = kept(build(due.join(faults.select(*INIT), INIT, "left_anti")))  # decoded once, for validation and writing
    if expected is not None:
        wrong = validate(product, expected, INIT)
        faults = faults.select(*INIT, "check").unionByName(wrong.select(*INIT, "check"))
        product = product.join(wrong.select(*INIT).distinct(), INIT, "left_anti")
    publish(spark, product, due, root, catalog, signatures)
    return faults.select(*INIT, "check")


def publish(spark: SparkSession, product: DataFrame, due: DataFrame, root: str, catalog: str, signatures: DataFrame) -> None:
    """Withdraw the runs ``due`` (INIT), write them, and bring their sources' catalog up to date; runs without a signature stay out.

    ``plans.publication.publish_runs`` also reads back what it has written.
    """
    due = kept(due.select(*INIT).distinct())
    inits, sources = with_init(due), [r["source"] for r in due.select("source").distinct().collect()]  # the few sources of one call
    for source in sources:
        remove(spark, catalog, source, inits.filter(F.col("source") == source))
    write_product(product, root)
    built = read_product(spark, root).join(due, INIT, "left_semi")
    rows = kept(products_of(definitions(built), signatures))
    for source in sources:
        upsert(spark, catalog, rows, source, inits)
