"""Files by name: sources, clips, edit lists and the transcripts that replace others; optional files, settings."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import text as T

WORDS = "w string, start double, end double, prob double"
#: Extensions of sources, the best first, and the folders that hold no sources.
EXTENSIONS = [".mov", ".mp4", ".mkv", ".webm"]
SKIPPED, SKIPPED_STARTS = ["загрузить"], ["_", "clips"]


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path (below the folder), modified, bytes of every file; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = urlparse(folder).path.rstrip("/") + "/"
    below = F.substr("path", F.instr("path", root) + F.lit(len(root)))
    return files.select(below.alias("path"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """w, start, end, prob, file: the words of JSON arrays, one row for each word."""
    return spark.read.schema(WORDS).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))


def optional_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """value: the JSON document of a file by its schema; no row where there is no such file, or it holds null."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        text = spark.createDataFrame([], "value string")
    return text.select(F.from_json("value", schema).alias("value")).filter("value is not null")


def hooks(spark: SparkSession, path: str) -> DataFrame:
    """edl, a, b of each edit list that has a hook; empty without the file."""
    pairs = optional_json(spark, path, "map<string,array<double>>").select(F.explode("value").alias("edl", "v"))
    return pairs.select("edl", F.get("v", F.lit(0)).alias("a"), F.get("v", F.lit(1)).alias("b"))


def visual(spark: SparkSession, path: str) -> DataFrame:
    """edl: the edit lists named in the file; empty without it."""
    return optional_json(spark, path, "array<string>").select(F.explode("value").alias("edl")).distinct()


def key_values(spark: SparkSession, path: str) -> DataFrame:
    """key, value of `key=value` lines; `#` lines and lines without `=` are left out, the last of equal keys counts."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line"))
    pair = F.split(F.trim("line"), "=", 2)
    own = lines.filter(~F.trim("line").startswith("#") & F.contains("line", F.lit("="))).select("ord", F.trim(pair[0]).alias("key"), F.regexp_replace(F.regexp_replace(F.trim(pair[1]), '^"+|"+$', ""), "^'+|'+$", "").alias("value"))
    return own.groupBy("key").agg(F.max_by("value", "ord").alias("value"))


def skipped(folder: Column) -> Column:
    """Whether a folder holds no sources, in any case of its letters."""
    low = F.lower(folder)
    return low.isin(SKIPPED) | F.exists(F.array(*map(F.lit, SKIPPED_STARTS)), lambda s: F.startswith(low, s))


def _last(path: str | Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def find_sources(files: DataFrame, names: DataFrame) -> DataFrame:
    """name, path, n_below: the file of each name (names: name), of the first extension that the root has.

    Where the root has none, the one file in the folders directly below it, skipped ones left out. None or
    several of them leave path null; n_below tells which.
    """
    depth, ext = F.size(F.split("path", "/")), F.regexp_extract("path", r"\.[^./]*$", 0)
    rank = F.array_position(F.array(*map(F.lit, EXTENSIONS)), ext)
    own = files.select("path", depth.alias("depth"), rank.alias("rank"), F.regexp_extract(_last("path"), r"^(.*)\.[^.]*$", 1).alias("name"))
    own = own.filter((F.col("rank") > 0) & ((F.col("depth") == 1) | (F.col("depth") == 2) & ~skipped(F.split("path", "/")[0]))).distinct()
    best = own.groupBy("name").agg(F.min(F.when(F.col("depth") == 1, F.struct("rank", "path"))).alias("root"), F.count_if(F.col("depth") == 2).alias("n"), F.min(F.when(F.col("depth") == 2, F.col("path"))).alias("below"))
    return names.select("name").distinct().join(best, "name", "left").select("name", F.coalesce("root.path", F.when(F.col("n") == 1, F.col("below"))).alias("path"), F.coalesce("n", F.lit(0)).alias("n_below"))


def required(found: DataFrame) -> DataFrame:
    """name, path of `find_sources`; the job fails on a name without a file or with several."""
    why = F.concat(F.lit("files found for "), "name", F.lit(": "), F.col("n_below").cast("string"))
    return found.select("name", F.coalesce("path", F.raise_error(why)).alias("path"))


def clips(files: DataFrame, only: str | None = None, limit: int | None = None) -> DataFrame:
    """path, src (its first part), target of the .mov files; of one source, or the first ones by path, if asked for."""
    own = files.filter(F.lower("path").endswith(".mov")).select("path", F.split("path", "/")[0].alias("src"), F.concat(F.regexp_replace("path", r"(?i)\.mov$", ""), F.lit(".mp4")).alias("target"))
    own = own if only is None else own.filter(F.col("src") == only)
    return own if limit is None else own.orderBy("path").limit(limit)


def with_features(files: DataFrame) -> DataFrame:
    """src: folders that hold a features.csv."""
    return files.filter(F.col("path").rlike(r"^[^/]+/features\.csv$")).select(F.split("path", "/")[0].alias("src")).distinct()


def edit_list_of(edits: DataFrame) -> DataFrame:
    """name, path: the first edit list (path, src, source) of each source that is the source's own.

    In order: `name.json`, `name/edl.json`, then in each folder of `name` for edits, by its name: edl.json,
    the base's `_edit.json`, `name.json`, and files with the base in their name. The base is the name without
    digits at its end. A list is the source's own if its src is the name, or its source contains it.
    """
    parts = F.split("path", "/")
    depth = F.size(parts)
    name = F.when(depth == 1, F.regexp_replace("path", r"\.json$", "")).otherwise(parts[0])
    own = edits.filter(F.endswith("path", F.lit(".json")) & (depth <= 3)).select("path", "src", "source", depth.alias("depth"), name.alias("name"), F.when(depth == 3, parts[1]).otherwise("").alias("folder"), _last("path").alias("file"))
    own = own.filter((F.col("src") == F.col("name")) | F.contains("source", "name"))
    base = F.coalesce(F.nullif(F.regexp_replace("name", "[0-9]+$", ""), F.lit("")), "name")
    inside = (F.col("depth") == 3) & F.col("folder").rlike("_edit$|^tt$|^edl")
    file = F.col("file")
    kind = F.when(F.col("depth") == 1, 0).when((F.col("depth") == 2) & (file == "edl.json"), 1)
    kind = kind.when(inside & (file == "edl.json"), 2).when(inside & (file == F.concat(base, F.lit("_edit.json"))), 3).when(inside & (file == F.concat("name", F.lit(".json"))), 4).when(inside & F.contains(file, base), 5)
    own = own.withColumn("kind", kind).filter("kind is not null")
    return own.groupBy("name").agg(F.min_by("path", F.struct(F.least("kind", F.lit(2)), "folder", "kind", "file")).alias("path"))


def words_for(edits: DataFrame, files: DataFrame, sidecars: DataFrame, transcripts: DataFrame) -> DataFrame:
    """edit, origin and the words of each edit list (edit, stem, name, src).

    The words of the sidecar (stem, words' columns) named as the list's file, else of that named as the list,
    else of the source's transcript (src, the same columns). A sidecar exists if `files` (stem) has it, so
    one without words leaves its list without any.
    """
    have = files.select("stem").distinct()
    has = edits.join(have.select("stem", F.col("stem").alias("by_stem")), "stem", "left").join(have.select(F.col("stem").alias("name"), F.col("stem").alias("by_name")), "name", "left")
    has = has.select("edit", "src", F.coalesce("by_stem", "by_name").alias("stem"))
    columns = [c for c in transcripts.columns if c != "src"]
    own = has.filter("stem is not null").select("edit", "stem").join(sidecars, "stem").select("edit", F.lit("sidecar").alias("origin"), *columns)
    return own.unionByName(has.filter("stem is null").select("edit", "src").join(transcripts, "src").select("edit", F.lit("transcript").alias("origin"), *columns))


def references(rows: DataFrame) -> DataFrame:
    """src, folder, num, name, start, end (seconds) of reference intervals (key, num, start, end as clock times, name).

    A key is a source, or a source and a folder of it with a slash between; the folder is then the whole key.
    """
    folder = F.when(F.contains("key", F.lit("/")), F.col("key")).otherwise(F.lit(""))
    return rows.select(F.split_part("key", F.lit("/"), F.lit(1)).alias("src"), folder.alias("folder"), "num", "name", T.parse_clock(F.col("start")).alias("start"), T.parse_clock(F.col("end")).alias("end"))


def read_references(spark: SparkSession, path: str) -> DataFrame:
    """`references` of JSON lines; no file gives no rows."""
    schema = "key string, num int, start string, end string, name string"
    try:
        found = spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], schema)
    return references(found)
