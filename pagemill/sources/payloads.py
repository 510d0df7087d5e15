"""Page payloads, category lists and manifests as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.compare import digest_sum

REVISION = ("struct<revid:bigint,`*`:string,slots:struct<main:struct<contentmodel:string,contentformat:string,`*`:string>>>")
PAGE = f"struct<pageid:bigint,ns:int,title:string,missing:string,revisions:array<{REVISION}>,categories:array<struct<ns:int,title:string>>>"
PAYLOAD = f"query struct<pages:map<string,{PAGE}>>, _corrupt_record string"


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """A1, A2: one JSON document per file. A document that does not parse keeps its text and no page."""
    return spark.read.schema(PAYLOAD).option("multiLine", True).option("mode", "PERMISSIVE").json(folder).withColumn(
        "raw_file", F.col("_metadata.file_path"))


def parse_payloads(documents: DataFrame, raw: str = "payload") -> DataFrame:
    """A1, A2 for payload texts that already are a column (``raw_file``, ``payload``)."""
    parsed = F.from_json(raw, PAYLOAD, {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"})
    return documents.withColumn("p", parsed).select("raw_file", F.col("p.query").alias("query"), F.col("p._corrupt_record").alias("_corrupt_record"))


def _page() -> Column:
    return F.get(F.map_values("query.pages"), F.lit(0))


def pages(payloads: DataFrame) -> DataFrame:
    """A1: identity, text, revision and categories of every readable payload."""
    revision = F.get(F.col("page.revisions"), F.lit(0))
    good = payloads.filter(F.col("query.pages").isNotNull() & (F.size("query.pages") == 1)).withColumn("page", _page())
    return good.select(
        F.col("raw_file").alias("page_key"), "raw_file", F.col("page.pageid").alias("page_id"), F.col("page.title").alias("title"), F.col("page.ns").alias("ns"),
        F.coalesce(revision["slots"]["main"]["*"], revision["*"], F.lit("")).alias("text"), revision["revid"].alias("revision_id"),
        (F.col("page.missing").isNotNull() | revision.isNull()).alias("missing"),
        F.coalesce(F.transform("page.categories", lambda c: c["title"]), F.array().cast("array<string>")).alias("payload_categories"))


def payload_failures(payloads: DataFrame) -> DataFrame:
    """Payloads that do not hold exactly one page become failure rows; the run goes on."""
    bad = payloads.filter(F.col("query.pages").isNull() | (F.size("query.pages") != 1))
    reason = F.when(F.col("query.pages").isNull(), "unreadable").otherwise("page_count")
    return bad.select("raw_file", F.lit("invalid_page_payload").alias("rule"), reason.alias("message"))


def category_members(spark: SparkSession, folder: str) -> DataFrame:
    """A3: one JSON list of titles per category file."""
    lists = spark.read.text(folder, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    members = F.from_json("value", "array<string>")
    return lists.select(F.regexp_replace("file", r"\.json$", "").alias("category"), F.posexplode(members).alias("pos", "title"))


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and hash of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def manifest_fingerprint(files: DataFrame) -> DataFrame:
    """One fingerprint for a file list, independent of order and never gathered in one place."""
    row = F.sha2(F.concat_ws("|", "path", "size_bytes", "sha256"), 256)
    return digest_sum(files, row, F.count("*").alias("file_count"), F.sum("size_bytes").cast("bigint").alias("bytes"), out="fingerprint")
