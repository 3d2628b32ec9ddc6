"""Manifests of forecast runs: reading, listing, building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import init_time

MANIFEST = """
schema_version int, source struct<name:string>, init_time string, date string, cycle int, completed_at string,
variables array<map<string,string>>, failures array<map<string,string>>,
files array<struct<step_hours:int,path:string,size_bytes:bigint,sha256:string,records_selected:int>>,
probability_availability struct<schema_version:int,policy:string,status:string,expected_samples:map<string,array<int>>,
 available_samples:map<string,array<int>>,missing_samples:map<string,array<int>>,missing_variables:array<string>,
 grid_resolution_degrees:double,bundles:array<struct<bundle:int,status:string,selected_records:int,index_sha256:string,available_events:array<array<string>>>>>
"""


def shaped(raw: DataFrame) -> DataFrame:
    """Manifest rows as the operators want them, from rows of MANIFEST (and maybe _metadata)."""
    return raw.select(
        "schema_version", F.col("source.name").alias("source"), F.try_to_date("date", "yyyyMMdd").alias("init_date"), "cycle",
        F.try_to_timestamp("completed_at").alias("completed_at"), F.coalesce("files", F.array()).alias("files"), F.size(F.coalesce("files", F.array())).alias("n_files"),
        F.size(F.coalesce("failures", F.array())).alias("n_failures"), F.col("probability_availability.status").alias("contract_status"), "probability_availability",
        F.col("_metadata.file_path").alias("manifest_path"), F.col("_metadata.file_modification_time").alias("manifest_time"),
    )


def read_manifests(spark: SparkSession, root: str, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifests, rejected) below root, or below one source's folder, by path; a missing folder has none."""
    path = f"{root}/{source}" if source else root
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        empty = spark.createDataFrame([], MANIFEST).withColumn("_metadata", F.struct(F.lit("").alias("file_path"), F.lit(None).cast("timestamp").alias("file_modification_time")))
        return shaped(empty), shaped(empty)
    raw = spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.manifest.json").json(path)
    known = F.col("schema_version").eqNullSafe(F.lit(1))
    return shaped(raw.filter(known)).orderBy("manifest_path"), shaped(raw.filter(~known)).orderBy("manifest_path")


def manifest_files(manifests: DataFrame) -> DataFrame:
    """One row a step file, records_selected 0 where a manifest does not say."""
    others = [c for c in manifests.columns if c != "files"]
    out = manifests.select(*others, F.explode("files").alias("file")).select(*others, "file.*")
    return out.withColumn("records_selected", F.coalesce("records_selected", F.lit(0)))


# How raw files of a run are named below a root, as (day, cycle, step); sources without a form of their own have the first.
RAW_NAMES = {
    "": r"^[^/]+/(\d{8})/(\d{2})z/f(\d{3})\.subset\.grib2$",
}


def grammars(spark: SparkSession, more: dict[str, str] | None = None) -> DataFrame:
    """(grammar_source, pattern): the forms of raw names, those of ``more`` (source to pattern with groups day, cycle, step) besides or instead."""
    return spark.createDataFrame(sorted((RAW_NAMES | (more or {})).items()), "grammar_source string, pattern string")


def named_files(listing: DataFrame, forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files, rejected) of a storage listing (path, size_bytes) by the grammar of each path's source, its first folder.

    files: source, init_date, cycle, step_hours, path, size_bytes. A name that is
    of no form, or tells no day, is rejected, as are unfinished files.
    """
    of = listing.select("path", "size_bytes", F.element_at(F.split("path", "/"), 1).alias("source"))
    own = forms.filter("grammar_source <> ''")
    known = of.join(F.broadcast(own), F.col("source") == F.col("grammar_source"), "left")  # a row a source
    common = forms.filter("grammar_source = ''").select(F.col("pattern").alias("common"))
    known = known.join(F.broadcast(common), F.col("pattern").isNull(), "left").withColumn("form", F.coalesce("pattern", "common"))  # one row
    piece = lambda k: F.expr(f"regexp_extract(path, coalesce(form, '$.'), {k})")
    read = known.withColumns({"day": F.try_to_date(piece(1), "yyyyMMdd"), "hour": piece(2).try_cast("int"), "step": piece(3).try_cast("int")})
    whole = F.col("day").isNotNull() & F.col("hour").between(0, 23) & F.col("step").isNotNull()
    files = read.filter(whole).select("source", F.col("day").alias("init_date"), F.col("hour").alias("cycle"), F.col("step").alias("step_hours"), "path", "size_bytes")
    return files, read.filter(~F.coalesce(whole, F.lit(False))).select("path", "size_bytes")


def manifest_name() -> Column:
    """Where the manifest of a run stands below the root of its files."""
    day, hour = F.date_format("init_date", "yyyyMMdd"), F.lpad(F.col("cycle").cast("string"), 2, "0")
    return F.concat_ws("/", "source", day, F.concat(hour, F.lit("z")), F.concat(day, F.lit("_"), hour, F.lit("z_"), "source", F.lit(".manifest.json")))


def write_manifests(made: DataFrame, root: str) -> int:
    """One JSON file a run of ``build_manifests`` below root, written by the tasks; how many there are.

    A task that runs again writes the same files again, each complete or not there under its name.
    """

    def run(frames):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        for frame in frames:
            for name, text in zip(frame["name"], frame["manifest"], strict=True):
                path = f"{base.rstrip('/')}/{name}"
                store.create_dir(path.rsplit("/", 1)[0])
                with store.open_output_stream(f"{path}.part") as out:
                    out.write(text.encode())
                store.move(f"{path}.part", path)
            yield frame[["name"]]

    return made.select(manifest_name().alias("name"), "manifest").mapInPandas(run, "name string").count()


def build_manifests(listing: DataFrame, existing: DataFrame, first: Column, last: Column, cycles: tuple[int, ...] = (0, 6, 12, 18)) -> DataFrame:
    """Manifests, as JSON text, for inits of a range of days (both ends, every day) that have files and no manifest.

    listing: source, init_date, cycle, step_hours, path, size_bytes, sha256 (null where files are not hashed).
    """
    keys = ["source", "init_date", "cycle"]
    calendar = listing.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("init_date")).select("init_date", F.explode(F.array(*map(F.lit, cycles))).alias("cycle"))
    wanted = listing.join(F.broadcast(calendar), ["init_date", "cycle"], "left_semi").join(existing.select(*keys), keys, "left_anti")
    file = F.struct("step_hours", "path", "size_bytes", "sha256", F.lit(0).alias("records_selected"))
    grouped = wanted.groupBy(*keys).agg(F.sort_array(F.collect_list(file)).alias("files"))  # the step files of one run
    at = F.date_format(init_time(F.col("init_date"), F.col("cycle")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    none = F.array().cast("array<map<string,string>>")
    body = F.struct(F.lit(1).alias("schema_version"), F.struct(F.col("source").alias("name")).alias("source"), at.alias("init_time"), F.date_format("init_date", "yyyyMMdd").alias("date"), F.col("cycle"), at.alias("completed_at"), none.alias("variables"), none.alias("failures"), F.col("files"))
    return grouped.select(*keys, F.to_json(body).alias("manifest"))
