"""JSONL sources and sinks with the policies for malformed lines, and discovery of session files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAIL, PARTIAL_TAIL, SKIP = "fail", "partial_tail", "skip"


def lines(spark: SparkSession, path: str, keep_blank: bool = False) -> DataFrame:
    """``file, line_no, text, value`` of each line; lines end at a line feed only, ``value`` is null where it isn't an object.

    The line number needs a file as a whole, so a file should fit in memory; many files are read in parallel.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), "value")
    split = files.select("file", F.posexplode(F.split("value", "\n")).alias("line_no", "text"), F.size(F.split("value", "\n")).alias("_n"))
    kept = split.where(~((F.col("line_no") == F.col("_n") - 1) & (F.col("text") == ""))).drop("_n")
    kept = kept if keep_blank else kept.where(F.regexp_replace("text", r"\s", "") != "")
    value = F.try_parse_json("text")
    whole = F.col("text").rlike(r"\}\s*$") & F.col("text").rlike(r"^\s*\{")
    return kept.withColumn("value", F.when(whole, value))


def read_jsonl(spark: SparkSession, path: str, schema: str, malformed: str = FAIL, required: list[str] | None = None) -> DataFrame:
    """Typed rows with ``file`` and ``line_no``.

    ``fail`` raises on a bad line, ``partial_tail`` only forgives the last line of a file, ``skip`` drops bad lines.
    Rows without a ``required`` field are errors.
    """
    if malformed not in (FAIL, PARTIAL_TAIL, SKIP):
        raise ValueError(f"unknown policy {malformed}")
    rows = lines(spark, path)
    bad = F.col("value").isNull()
    if malformed == PARTIAL_TAIL:
        last = rows.groupBy("file").agg(F.max("line_no").alias("_last"))
        rows = rows.join(last, "file").where(~(bad & (F.col("line_no") == F.col("_last")))).drop("_last")
    if malformed == SKIP:
        rows = rows.where(~bad)
    else:
        where = F.concat(F.lit("bad JSON object in "), F.col("file"), F.lit(", line "), (F.col("line_no") + 1).cast("string"))
        rows = rows.withColumn("text", F.when(bad, F.raise_error(where)).otherwise(F.col("text")))
    typed = rows.select("file", "line_no", F.from_json("text", schema).alias("r"))
    for name in required or []:
        missing = F.concat(F.lit(f"no {name} in "), F.col("file"), F.lit(", line "), (F.col("line_no") + 1).cast("string"))
        typed = typed.withColumn("r", F.when(F.col(f"r.{name}").isNull(), F.raise_error(missing)).otherwise(F.col("r")))
    return typed.select("file", "line_no", "r.*")


def malformed_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines and malformed lines of each file."""
    return lines(spark, path).groupBy("file").agg(F.count("*").alias("n_lines"), F.count_if(F.col("value").isNull()).alias("n_malformed"))


def session_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, session_id, variant`` of files below ``session_<id>[_sN]`` folders."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").load(path).select(F.col("path").alias("file"), "modificationTime", "length")
    named = listed.withColumns({"session_id": F.regexp_extract("file", r"/session_(\d+)(?:_s\d+)?/", 1).try_cast("long"), "variant": F.nullif(F.regexp_extract("file", r"/session_\d+(_s\d+)/", 1), F.lit(""))})
    return named.where("session_id is not null")


def first_variants(files: DataFrame) -> DataFrame:
    """The first file of each session: plain before variants, then by depth and path; with ``files``, all of its paths in order."""
    rank = F.struct(F.col("variant").isNotNull().alias("is_variant"), F.size(F.split("file", "/")).alias("depth"), F.col("file"))
    # the variants of a session are bounded by how often it was run
    return files.groupBy("session_id").agg(F.min(rank).getField("file").alias("file"), F.count("*").alias("n_variants"), F.array_sort(F.collect_list("file")).alias("files"))


def variant_of(files: DataFrame, suffixes: tuple[str, ...] = ("", *(f"_s{k}" for k in range(10)))) -> DataFrame:
    """``session_id, file`` of the first of the suffixes that a session has, in their order; the least path of equal ones."""
    place = F.array_position(F.array(*map(F.lit, suffixes)), F.coalesce("variant", F.lit("")))
    return files.withColumn("_place", place).where("_place > 0").groupBy("session_id").agg(F.min(F.struct("_place", "file")).getField("file").alias("file"))


def newest_files(files: DataFrame, most: int | None = None) -> DataFrame:
    """The first ``most`` sessions by id, or all files with the newest first."""
    if most is None:
        return files.orderBy(F.desc("modificationTime"), F.desc("file"))
    return first_variants(files).orderBy("session_id").limit(most)


def read_benchmark(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Benchmark items from JSONL; ``images`` get the folder of their source in front."""
    rows = read_jsonl(spark, path, schema)
    return rows.withColumn("images", F.transform("images", lambda x: F.concat(F.lit("images/"), F.col("source_dataset"), F.lit("/"), x)))


def run_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``file`` and the fields of each readable ``task_*/result.json`` of a run, sorted by source, id and key."""
    files = spark.read.text(f"{path}/task_*/result.json", wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    typed = files.where(F.try_parse_json("value").isNotNull() & F.col("value").rlike(r"^\s*\{")).select("file", F.from_json("value", schema).alias("r")).select("file", "r.*")
    return typed.orderBy(*(c for c in ("source_dataset", "id", "task_key") if c in typed.columns), "file")


def turn_traces(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Turns of trace files without the header (step -1); a file with any bad line has none."""
    rows = lines(spark, path)
    sound = rows.groupBy("file").agg(F.max(F.col("value").isNull()).alias("_bad")).where("not _bad").select("file")
    typed = rows.join(sound, "file").select("file", "line_no", F.from_json("text", schema).alias("r")).select("file", "line_no", "r.*")
    return typed.where(F.coalesce("step", F.lit(0)) != -1)


def resolved_paths(wanted: DataFrame, there: DataFrame, roots: list[str]) -> DataFrame:
    """Paths with the file that each stands for: ``key, path, file``; null where there is none.

    ``wanted`` has ``key, path``; ``there`` the existing ``file`` names; candidates are, in order, the path itself if it is absolute, it
    below each root, its name below each root, and what stands behind a ``session_`` folder below each root.
    """
    clean = F.regexp_replace(F.trim("path"), "^[\"']|[\"']$", "")
    name, behind = F.element_at(F.split(clean, "/"), -1), F.nullif(F.regexp_extract(clean, r"(?:^|/)session_[^/]*/(.*)$", 1), F.lit(""))
    below = lambda part: [F.concat(F.lit(r.rstrip("/") + "/"), part) for r in roots]
    tried = F.array(F.when(clean.startswith("/"), clean), *(F.when(~clean.startswith("/"), c) for c in below(clean)), *below(name), *below(behind))
    each = wanted.select("key", "path", F.posexplode(tried).alias("_place", "file")).where("file is not null")
    hit = each.join(there.select("file").distinct(), "file").groupBy("key", "path").agg(F.min(F.struct("_place", "file")).getField("file").alias("file"))
    return wanted.join(hit, ["key", "path"], "left").select("key", "path", "file")


def image_size(pairs: list[tuple[str, str]], columns: list[str], head: Column | None = None) -> Column:
    """``width, height`` from the first pair of fields that has both, else from the head of a PNG file (bytes)."""
    known = [F.when(F.col(w).isNotNull() & F.col(h).isNotNull(), F.struct(F.col(w).cast("int").alias("width"), F.col(h).cast("int").alias("height"))) for w, h in pairs if w in columns and h in columns]
    if head is not None:
        number = lambda at: F.conv(F.hex(F.substring(head, at, 4)), 16, 10).cast("int")
        known.append(F.when(F.hex(F.substring(head, 1, 8)) == "89504E470D0A1A0A", F.struct(number(17).alias("width"), number(21).alias("height"))))
    return F.coalesce(*known) if known else F.lit(None).cast("struct<width: int, height: int>")


def rewrite_sorted(spark: SparkSession, staged: str, final: str, key: str) -> None:
    """What was appended to ``staged``, once per key and sorted, as the final JSONL; the staged rows stay until that is written."""
    rows = spark.read.json(staged)
    rows.dropDuplicates([key]).orderBy(key).write.mode("overwrite").json(final)


def session_list(spark: SparkSession, path: str) -> DataFrame:
    """``file, key, created_at, updated_at`` from the metadata lines of session files, the latest update first."""
    rows = lines(spark, path).where(F.try_variant_get("value", "$._type", "string") == "metadata")
    return rows.select("file", *(F.try_variant_get("value", f"$.{k}", "string").alias(k) for k in ("key", "created_at", "updated_at"))).orderBy(F.desc("updated_at"), "file")


def write_session(rows: DataFrame, metadata: dict, path: str) -> None:
    """A session as JSONL: its metadata line, then its messages (with ``line_no``) in order; a session fits in one file."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(-1, json.dumps({"_type": "metadata", **metadata}, ensure_ascii=False))], "line_no int, value string")
    body = rows.select(F.col("line_no").cast("int").alias("line_no"), F.to_json(F.struct(*(c for c in rows.columns if c not in ("file", "line_no")))).alias("value"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("line_no").select("value").write.mode("overwrite").text(path)


def read_sessions(spark: SparkSession, path: str, best_effort: bool = False) -> DataFrame:
    """Messages of session files: ``file, line_no, role, content, tool_calls, tool_call_id, name, timestamp``, the metadata line left out.

    A file with any bad or blank line has one row with role ``parse_error``, or none with ``best_effort``.
    """
    rows = lines(spark, path, keep_blank=True)
    broken = rows.groupBy("file").agg(F.max(F.col("value").isNull()).alias("_broken"))
    text = lambda k: F.coalesce(F.try_variant_get("value", f"$.{k}", "string"), F.nullif(F.to_json(F.try_variant_get("value", f"$.{k}", "variant")), F.lit("null")))
    read = rows.join(broken, "file")
    good = read.where("not _broken").where(F.coalesce(F.try_variant_get("value", "$._type", "string"), F.lit("")) != "metadata").select("file", "line_no", *(text(k).alias(k) for k in ("role", "content", "tool_calls", "tool_call_id", "name", "timestamp")))
    if best_effort:
        return good
    bad = broken.where("_broken").select("file", F.lit(0).alias("line_no"), F.lit("parse_error").alias("role"), *(F.lit(None).cast("string").alias(k) for k in ("content", "tool_calls", "tool_call_id", "name", "timestamp")))
    return good.unionByName(bad)


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite", one_file: bool = False, order: list[str] | None = None) -> None:
    """Rows as JSONL, nulls left out; sorted by ``order`` if given, one file only on request for small results."""
    rows = rows.orderBy(*order) if order else rows
    rows = rows.coalesce(1) if one_file else rows
    rows.write.mode(mode).json(path)


def write_report(summary: DataFrame, path: str) -> None:
    """A one-row summary as a JSON file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def markdown_table(rows: DataFrame, most: int = 1000) -> str:
    """A small report as a Markdown table; ``most`` bounds what is brought to the driver, more rows are an error."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"a report has at most {most} rows")
    cells = [rows.columns, ["---"] * len(rows.columns), *([("" if v is None else str(v)) for v in r] for r in got)]
    return "\n".join("| " + " | ".join(c) + " |" for c in cells)
