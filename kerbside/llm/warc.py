"""WARC archives: write pages as transactions of records, read archives back, and assemble the transactions again.

An archive is a folder of gzipped WARC 1.1 files. Every page becomes a request, a response (or a revisit of an earlier payload)
and a metadata record; request and metadata name the response they belong to in WARC-Concurrent-To. Reading splits the files
into records and joins them through those identifiers to one nested row per capture. All of it is DataFrame work: Spark's text
source streams records, so a task holds one record at a time whatever the size of a file.

Every record opens with the identifier of its archive's warcinfo record, drawn anew for each archive, so that no payload can hold
what parts records; the declared lengths are verified besides.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .durable import durable, shared_folder

#: Payloads of fewer bytes are never revisited.
LEAST_REVISITED = 1000
#: Rows of a lookup table that is broadcast, some 200 bytes each; a longer one is joined by a shuffle with salted keys.
BROADCAST_ROWS = 100_000
#: Ways a key is split in such a shuffle.
SALTS = 64
#: Records a file of an archive holds at most.
FILE_RECORDS = 150_000

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
EOL = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit")


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _urn(*parts: Column | str) -> Column:
    """A UUID URN named by the parts."""
    return _text("urn:uuid:", F.regexp_replace(F.md5(_text(*parts).cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def _lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table that has one row a key: broadcast up to BROADCAST_ROWS, else by a shuffle that splits hot keys."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), keys, "left")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*(F.col(c) for c in ("page_id", "url", "record_id") if c in rows.columns)), F.lit(SALTS)).cast("int"))
    spread = table.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return salted.join(spread, [*keys, "salt"], "left").drop("salt")


def _record(info: str, kind: str, record_id: Column, date: str, extra: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """One record up to its last line end, which the text writer adds. A header whose value is null is left out."""
    fixed = _text(f"{VERSION}{EOL}WARC-Warcinfo-ID: <{info}>{EOL}WARC-Type: {kind}{EOL}WARC-Record-ID: <", record_id, f">{EOL}WARC-Date: {date}{EOL}")
    named = [F.coalesce(_text(f"{name}: ", value, EOL), F.lit("")) for name, value in extra]
    size = F.octet_length(block).cast("string")
    return _text(fixed, *named, f"Content-Type: {content_type}{EOL}Content-Length: ", size, END, block, EOL)


def write_archive(pages: DataFrame, path: str, *, date: str | None = None) -> None:
    """Write (page_id, url, html) as an archive in the new folder ``path``.

    A null html is an empty payload. Of pages with equal payloads of at least LEAST_REVISITED bytes those with the largest page_id
    are responses and the others revisit them; a null page_id is below all others. Payloads are equal if length and SHA-256 are.
    Repeated rows give records with equal identifiers. Line ends within a url are percent-encoded; a null url leaves the target out.
    Payloads are not shuffled: only digests are, and the payloads that occur more than once are looked up by a checked broadcast.
    """
    spark = pages.sparkSession
    info = f"urn:uuid:{uuid.uuid4()}"
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(pages["html"], F.lit(""))
    url = F.replace(F.replace(pages["url"].cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), url.alias("url"), payload.alias("html")).select(
        "page_id", "url", "html", F.octet_length("html").alias("bytes"), F.sha2(F.col("html").cast("binary"), 256).alias("same")
    )
    groups = rows.where(F.col("bytes") >= LEAST_REVISITED).groupBy("same", "bytes")
    groups = groups.agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = _lookup(rows, durable(groups), ["same", "bytes"])

    def name(kind: str, page: Column, target: Column) -> Column:
        return _urn(f"{info}|{kind}|", F.col("same"), "|", F.coalesce(page.cast("string"), F.lit("")), "|", F.coalesce(target, F.lit("")))

    older = F.col("first").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first.page_id"), F.col("first.page_id").isNull())
    rows = found.select(
        "*", older.alias("revisits"), F.sha1(F.col("html").cast("binary")).alias("sha1"), name("capture", F.col("page_id"), F.col("url")).alias("capture"),
        name("capture", F.col("first.page_id"), F.col("first.url")).alias("original"), name("request", F.col("page_id"), F.col("url")).alias("request"),
        name("metadata", F.col("page_id"), F.col("url")).alias("metadata"),
    )

    def link(c: str | Column) -> Column:
        return _text("<", F.col(c) if isinstance(c, str) else c, ">")

    target = ("WARC-Target-URI", F.col("url"))
    belongs = ("WARC-Concurrent-To", link("capture"))
    digest = ("WARC-Payload-Digest", _text("sha1:", F.col("sha1")))
    place = F.coalesce(F.nullif(F.regexp_extract("url", "^[A-Za-z]+://[^/]*(/.*)$", 1), F.lit("")), F.lit("/"))
    host = F.coalesce(F.regexp_extract("url", "^[A-Za-z]+://([^/]*)", 1), F.lit(""))
    head = _text(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: ", F.col("bytes").cast("string"), END)
    fields = F.coalesce(_text("page-id: ", F.col("page_id").cast("string"), EOL), F.lit(""))
    http = "application/http; msgtype="
    asked = _record(info, "request", F.col("request"), date, [target, belongs], f"{http}request", _text("GET ", place, f" HTTP/1.1{EOL}Host: ", host, END))
    full = _record(info, "response", F.col("capture"), date, [target, digest], f"{http}response", _text(head, F.col("html")))
    again = [target, digest, ("WARC-Refers-To", link("original")), ("WARC-Refers-To-Target-URI", F.col("first.url")), ("WARC-Profile", F.lit(PROFILE))]
    seen = _record(info, "revisit", F.col("capture"), date, again, f"{http}response", head)
    about = _record(info, "metadata", F.col("metadata"), date, [target, belongs], "application/warc-fields", fields)
    records = rows.select(F.explode(F.array(asked, F.when(F.col("revisits"), seen).otherwise(full), about)).alias("value"))
    note = f"software: kerbside{EOL}format: WARC File Format 1.1{EOL}"
    first = f"{VERSION}{EOL}WARC-Type: warcinfo{EOL}WARC-Record-ID: <{info}>{EOL}WARC-Date: {date}{EOL}Content-Type: application/warc-fields{EOL}Content-Length: {len(note)}{END}{note}{EOL}"
    how = {"lineSep": EOL, "compression": "gzip"}
    records.write.options(**how, maxRecordsPerFile=FILE_RECORDS).text(f"{path}/records")
    spark.range(1).select(F.lit(first).alias("value")).coalesce(1).write.options(**how).text(f"{path}/warcinfo")


def _header(name: str) -> Column:
    """A header's value; null where the record has none."""
    return F.nullif(F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def _bare(link: Column) -> Column:
    return F.regexp_replace(link, "^<|>$", "")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive as ``write_archive`` leaves it, in no order.

    Returns type, record_id, target_uri, concurrent_to (array), refers_to, declared_digest, fields (of a metadata record, as a map), http
    (the block's HTTP head) and payload (binary; of other records than responses null). Header names match in any case. A record
    whose length is not the declared one fails the job.
    """
    own = spark.read.option("lineSep", EOL).text(f"{path}/warcinfo").where(F.col("value").startswith("WARC-Record-ID: "))
    info = own.select(_bare(F.substring_index("value", " ", -1))).first()[0]
    raw = spark.read.option("lineSep", f"{VERSION}{EOL}WARC-Warcinfo-ID: <{info}>{EOL}").text(f"{path}/records").where("value <> ''")
    parts = raw.select("value", F.substring_index("value", END, 1).alias("head"))
    size = _header("Content-Length").cast("long")
    parts = parts.select("head", F.col("value").cast("binary").alias("raw"), (F.octet_length("head") + 4).alias("skip"), size.alias("size"))
    whole = F.octet_length("raw") == F.col("skip") + F.col("size") + 4
    block = F.when(whole, F.substring("raw", F.col("skip") + 1, F.col("size").cast("int"))).otherwise(F.raise_error(_text("record of a wrong length: ", F.col("head"))))
    parts = parts.select("head", block.alias("block"), _header("WARC-Type").alias("type"), _header("Content-Type").alias("content"))
    parts = parts.withColumn("http", F.when(F.col("content").startswith("application/http"), F.substring_index(F.col("block").cast("string"), END, 1)))
    linked = F.regexp_extract_all("head", F.lit(r"(?i)(?:^|\r\n)WARC-Concurrent-To:[ \t]*<?([^\r\n>]*)"), 1)
    lines = F.filter(F.split(F.col("block").cast("string"), EOL), lambda x: F.contains(x, F.lit(":")))
    pairs = F.transform(lines, lambda x: F.struct(F.substring_index(x, ":", 1).alias("name"), F.ltrim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    # Of a name that is repeated the last value stands.
    fields = F.aggregate(pairs, F.expr("cast(map() as map<string,string>)"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["name"]), F.create_map(p["name"], p["value"])))
    start = F.octet_length("http") + 5
    return parts.select(
        "type", _bare(_header("WARC-Record-ID")).alias("record_id"), _header("WARC-Target-URI").alias("target_uri"), linked.alias("concurrent_to"),
        _bare(_header("WARC-Refers-To")).alias("refers_to"), F.regexp_replace(_header("WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        F.when(F.col("type") == "metadata", fields).alias("fields"), "http",
        F.when(F.col("type") == "response", F.substring("block", start, F.greatest(F.lit(0), F.octet_length("block") - start + 1).cast("int"))).alias("payload"),
    )


def record_heads(records: DataFrame) -> DataFrame:
    """Records with the length and SHA-1 of each payload in its place."""
    measured = [F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")]
    return records.select(*(c for c in records.columns if c != "payload"), *measured)


def assemble(heads: DataFrame) -> DataFrame:
    """One nested row per capture, from the rows of ``record_heads``.

    Returns record_id, type, target_uri, capture (the response's or revisit's columns), requests and metadata (arrays of its other
    records, by identifier), original (of a revisit, record_id, payload_bytes, payload_digest and fields of the response it refers
    to) and copies, the times that the capture's record occurs. A record belongs to the captures that it names in concurrent_to or
    that name it, or else through another record of theirs. Captures without request or metadata keep empty arrays; records that
    belong to no capture are left out, and a revisit whose response the archive lacks has a null original.
    """
    rest = [c for c in heads.columns if c != "record_id"]
    single = heads.groupBy("record_id").agg(*(F.first(c).alias(c) for c in rest), F.count("*").alias("copies"))
    captures = single.where(F.col("type").isin(*CAPTURES))
    others = single.where(~F.col("type").isin(*CAPTURES))
    named = others.select(F.col("record_id").alias("other"), F.explode("concurrent_to").alias("capture"))
    naming = captures.select(F.explode("concurrent_to").alias("other"), F.col("record_id").alias("capture"))
    known = captures.select(F.col("record_id").alias("capture"))
    direct = named.join(known, "capture", "left_semi").select("other", "capture").union(naming)
    through = named.select(F.col("other").alias("far"), F.col("capture").alias("other")).join(direct, "other").select(F.col("far").alias("other"), "capture")
    links = direct.union(through).distinct()
    members = links.join(others.withColumnRenamed("record_id", "other"), "other")
    nested = F.struct(F.col("other").alias("record_id"), "target_uri", "http", "fields")
    own = F.struct("declared_digest", "http", "payload_bytes", "payload_digest").alias("capture")
    joined = captures.select("record_id", "type", "target_uri", "copies", "refers_to", own)
    for column, kind in (("requests", "request"), ("metadata", "metadata")):
        ordered = F.array_sort(F.collect_list(nested), lambda a, b: F.when(a["record_id"] < b["record_id"], -1).when(a["record_id"] > b["record_id"], 1).otherwise(0))
        found = members.where(F.col("type") == kind).groupBy(F.col("capture").alias("record_id")).agg(ordered.alias(column))
        none = F.array().cast(found.schema[column].dataType)
        joined = joined.join(found, "record_id", "left").withColumn(column, F.coalesce(column, none))
    joined = durable(joined)
    wanted = joined.where(F.col("refers_to").isNotNull()).groupBy("refers_to").agg(F.count("*").alias("n"))
    responses = joined.where(F.col("type") == "response").select(
        F.col("record_id").alias("refers_to"), F.struct("record_id", "capture.payload_bytes", "capture.payload_digest", "metadata").alias("original")
    )
    originals = durable(wanted.join(responses, "refers_to").select("refers_to", "original"))
    return _lookup(joined, originals, ["refers_to"]).drop("refers_to")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Archive pages, read the archive back, and give each page's capture.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to (the page_id of the response that a revisit names) and
    n_requests. A row comes back as often as it was given. A revisit's length and digest are those of the response it refers to.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path)
    found = assemble(durable(record_heads(read_records(spark, path))))

    def page(metadata: str) -> Column:
        return F.get(F.col(metadata), F.lit(0))["fields"]["page-id"].cast("long")

    revisit = F.col("type") == "revisit"
    return found.select(
        page("metadata").alias("page_id"),
        F.when(revisit, F.col("original.payload_bytes")).otherwise(F.col("capture.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("original.payload_digest")).otherwise(F.col("capture.payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, page("original.metadata")).alias("refers_to"),
        F.size("requests").alias("n_requests"), F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def archive_sql() -> str:
    """DuckDB SQL for ``captures_of_pages``, without archives."""
    return f"""
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
        ), firsts AS (
            SELECT *, CASE WHEN payload_bytes >= {LEAST_REVISITED} THEN max(page_id) OVER (PARTITION BY payload) END AS latest FROM payloads
        )
        SELECT page_id, payload_bytes, sha1(payload) AS payload_digest, CASE WHEN latest > coalesce(page_id, latest - 1) THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN latest > coalesce(page_id, latest - 1) THEN latest END AS refers_to, 1::INTEGER AS n_requests
        FROM firsts
    """
