"""Scalar functions, outcome tables, sinks, and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs as I
from checks.answers import CONTENTS, _tags
from checks.rewriting import MESSAGES, said
from veil.functions import scalars as X
from veil.operators import model as M
from veil.plans import outcome as O
from veil.plans.mask import mask_sessions, mask_with_responses
from veil.sources import envelopes as E
from veil.streaming import jobs as J

# ------------------------------------------------------------- scalars


def _customer(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "customer").selectExpr(
        "c_custkey AS k", "c_name AS name", "left(c_name, CAST(c_custkey % 7 AS INT)) AS short")


def mask_secret(spark: SparkSession, sf: str) -> DataFrame:
    return X.mask_secret_columns(_customer(spark, sf), ["name", "short"])


def mask_by_key(spark: SparkSession, sf: str) -> DataFrame:
    settings = F.create_map(F.lit("AWS_KEY"), "name", F.lit("aws_key"), "name", F.lit("OTHER"), "short",
                            F.lit("AWS_SHORT"), "short")
    rows = _customer(spark, sf).select("k", X.mask_by_key(settings).alias("m"))
    return rows.select("k", *[F.col("m")[n].alias(n.lower() + str(i))
                              for i, n in enumerate(("AWS_KEY", "aws_key", "OTHER", "AWS_SHORT"))])


_ERROR = ("CASE k % 4 WHEN 0 THEN concat('Error of ', name, ' aws_request_id: 1 s3_extended_request_id: 2') "
          "WHEN 1 THEN concat(short, 's3_extended_request_id x aws_request_id') "
          "WHEN 2 THEN concat('aws_request_id', name) ELSE concat('plain ', name) END")


def cut_at_marker(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer(spark, sf).selectExpr("k", f"{_ERROR} AS message")
    return rows.select("k", X.cut_at_marker(F.col("message")).alias("message"))


def preview(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "documents").select(
        "doc_id", X.preview(F.col("text")).alias("head"),
        F.octet_length(X.preview_bytes(F.col("text"))).cast("bigint").alias("n_bytes"))


def url_bucket(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.table(spark, sf, "pages").select(
        "page_id", "url", F.concat(F.lit("s3://"), F.split_part("url", F.lit("/"), F.lit(3)), F.lit("/key")).alias("s3"))
    return rows.select("page_id", X.url_bucket(F.col("url")).alias("web"),
                       X.url_bucket(F.col("s3")).alias("stored"),
                       X.url_bucket(F.lit("s3:///key")).alias("empty"))


def _lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = _customer(spark, sf)
    return rows.select(
        "k", F.array(F.lit("a"), "name", F.lit("b"), F.lit("a")).alias("left"),
        F.array(F.lit("b"), "short", F.concat(F.lit("c"), (F.col("k") % 3).cast("string"))).alias("right"))


def merge_unique(spark: SparkSession, sf: str) -> DataFrame:
    merged = X.merge_unique(F.col("left"), F.col("right"))
    return _lists(spark, sf).select("k", F.array_join(F.sort_array(merged), "|").alias("merged"))


def missing_items(spark: SparkSession, sf: str) -> DataFrame:
    missing = X.missing_items(F.col("left"), F.col("right"))
    return _lists(spark, sf).select("k", F.array_join(F.sort_array(missing), "|").alias("missing"))


# ------------------------------------------------------------ outcomes

def answered(spark: SparkSession, sf: str, on_unparsed: str = "quarantine") -> DataFrame:
    """Messages masked with recorded responses; every fifth session has no answer."""
    responses = I.responses(spark, sf).select(
        F.concat(F.lit("log-"), F.col("session_id").cast("string"), F.lit("-0")).alias("session_name"),
        F.when(F.col("session_id") % 5 != 0, F.col("response")).alias("response"))
    return mask_with_responses(I.envelopes(spark, sf), responses, _tags(), on_unparsed)


def disposition(spark: SparkSession, sf: str) -> DataFrame:
    strict = answered(spark, sf).withColumn("policy", F.lit("quarantine"))
    loose = answered(spark, sf, "passthrough").withColumn("policy", F.lit("passthrough"))
    return strict.unionByName(loose).select(
        "policy", "seq", "session_name", "disposition", "saved", "retry",
        F.when(F.col("session_name").isNotNull(), F.col("pair_status")).alias("pair_status"))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The start of a payload is JSON text of this dialect, so only its length is compared."""
    return O.quarantine(answered(spark, sf)).select(
        "seq", "session_name", "disposition", F.char_length("payload_head").cast("bigint").alias("n_head"))


def latest_session(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.table(spark, sf, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("session_name"),
        F.col("event_id").alias("seq"), "event_type")
    return O.latest(rows.unionByName(rows))


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    """Events as finished messages: published at ``ts``, done ``value`` seconds later."""
    took = F.round(F.col("value") * 1000000).cast("bigint")
    published = F.col("ts").cast("timestamp")
    return I.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("session_name"),
        published.alias("published"),
        F.timestamp_add("MICROSECOND", F.floor(took / 2).cast("bigint"), published).alias("started"),
        F.timestamp_add("MICROSECOND", took, published).alias("finished"),
        F.when(F.col("event_type") == "error", O.MODEL_ERROR).when(
            F.col("event_type") == "view", O.PARSE_ERROR).otherwise(O.OK).alias("disposition"),
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("send_us"),
        (F.col("value") * 10).alias("total_ms"),
        F.when(F.col("event_id") % 2 == 0, F.create_map(
            F.lit(M.DURATION_HEADER), F.col("user_id").cast("string"))).alias("response_headers"))


def metrics_rows(spark: SparkSession, sf: str) -> DataFrame:
    return O.metrics_rows(_timed(spark, sf)).select(
        "seq", "session_name", "send_us", "storage", "storage_us", "memo_hit", "since_publish_us", "took_us")


def overhead_ms(spark: SparkSession, sf: str) -> DataFrame:
    reported = M.reported(F.col("response_headers"), M.DURATION_HEADER)
    return _timed(spark, sf).select("seq", F.round(O.overhead(F.col("total_ms"), reported), 4).alias("overhead_ms"))


def sink_json(spark: SparkSession, sf: str) -> DataFrame:
    path = I.shared_folder(spark, "sink")
    O.save_logs(mask_sessions(I.envelopes(spark, sf)), path)
    read = spark.read.schema("session_name STRING, seq BIGINT, log STRING").json(path)
    return said()(read).select("session_name", "seq", "said")


def publish_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    path = I.shared_folder(spark, "published")
    E.publish(I.envelopes(spark, sf), path)
    return E.read_envelopes(spark, path).select(
        "seq", "subject", E.session_name().alias("name"), F.char_length("payload").cast("bigint").alias("n_chars"))


def _kafka(spark: SparkSession, sf: str) -> DataFrame:
    """Events as records of a broker: offsets repeat in four partitions, a header comes twice."""
    def header(value: str):
        return F.struct(F.lit("k").alias("key"), F.col(value).cast("string").cast("binary").alias("value"))

    rows = I.table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").cast("string").cast("binary").alias("value"),
        F.array(header("user_id"), header("event_id")).alias("headers"))
    return E.from_kafka_columns(rows)


def kafka_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _kafka(spark, sf).select(
        "seq", "subject", F.col("headers")["k"].alias("k"),
        F.col("headers")[E.PARTITION_HEADER].alias("partition"), "payload")


def first_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """Every record comes twice; none is lost though offsets repeat."""
    rows = _kafka(spark, sf)
    return E.first_delivery(rows.unionByName(rows)).select("seq", "subject", "payload")


def not_ready(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.table(spark, sf, "customer").selectExpr("c_mktsegment AS component", "c_acctbal > 9000 AS ready")
    return X.not_ready(rows)


def missing_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without a large order."""
    required = I.table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_name AS name")
    return X.missing_rows(required, I.table(spark, sf, "orders").where("o_totalprice > 400000").selectExpr("o_custkey AS k"), ["k"])


def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    found = O.latency_percentiles(O.with_latency(_timed(spark, sf)), 1000000)
    return found.select("disposition", F.col("p50_p95_us")[0].alias("p50_us"), F.col("p50_p95_us")[1].alias("p95_us"))


# ------------------------------------------------------------- streams

# Files that a batch of the stream takes at once, so that what it shuffles is bounded.
BATCH = 100


def _publish_and_mask(spark: SparkSession, sf: str, again: bool = False, batch: int | None = BATCH, **options) -> str:
    """Publish the envelopes and run the stream; if asked, deliver the same lines ``again`` to the same checkpoint."""
    source, root = I.shared_folder(spark, "stream"), I.shared_folder(spark, "masked")

    def run() -> None:
        J.mask_stream(E.stream_envelopes(spark, source, max_files_per_trigger=batch), root, **options).awaitTermination()

    E.publish(I.envelopes(spark, sf), source)
    run()
    if again:
        spark.read.text(source).write.mode("append").text(source, compression=E.COMPRESSION)
        run()
    return root


def stream_mask(spark: SparkSession, sf: str) -> DataFrame:
    root = _publish_and_mask(spark, sf)
    return said()(J.latest_sessions(spark, root)).select("session_name", "seq", "said")


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """The job is stopped, everything is delivered again, and the job goes on."""
    root = _publish_and_mask(spark, sf, again=True)
    written = spark.read.parquet(J.Folders(root).sessions)
    return written.groupBy("session_name").agg(F.count("*").alias("n"))


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    source, sink = I.shared_folder(spark, "dedup"), I.shared_folder(spark, "deduped")
    E.publish(I.envelopes(spark, sf), source)
    (
        J.drop_repeats(E.stream_envelopes(spark, source)).select("seq", "subject", "payload").writeStream
        .option("checkpointLocation", f"{sink}/checkpoint").trigger(availableNow=True)
        .format("parquet").start(f"{sink}/rows").awaitTermination()
    )
    return spark.read.parquet(f"{sink}/rows").select(
        "seq", "subject", F.char_length("payload").cast("bigint").alias("n_chars"))


def stream_retry(spark: SparkSession, sf: str) -> DataFrame:
    """Messages without a name come back once, with the next batch, then are given up."""
    # Tries are counted by batches, so a delivery is one batch here, however large.
    root = _publish_and_mask(spark, sf, again=True, batch=None, remember=None, max_attempts=2)
    gave_up = spark.read.parquet(J.Folders(root).gave_up).select("seq", _bigint("attempts"))
    tried = spark.read.parquet(J.Folders(root).outcomes).where("retry").select(
        "seq", _bigint("attempts"))
    return tried.withColumn("table", F.lit("outcomes")).unionByName(
        gave_up.withColumn("table", F.lit("gave_up")))


def _bigint(name: str):
    return F.col(name).cast("bigint").alias(name)


QUERIES = {
    "mask_secret": mask_secret,
    "mask_by_key": mask_by_key,
    "cut_at_marker": cut_at_marker,
    "preview": preview,
    "url_bucket": url_bucket,
    "merge_unique": merge_unique,
    "missing_items": missing_items,
    "disposition": disposition,
    "quarantine": quarantine,
    "latest_session": latest_session,
    "kafka_columns": kafka_columns,
    "first_delivery": first_delivery,
    "not_ready": not_ready,
    "missing_rows": missing_rows,
    "latency_percentiles": latency_percentiles,
    "metrics_rows": metrics_rows,
    "latency_us": lambda spark, sf: O.with_latency(_timed(spark, sf)).select(
        "seq", "since_publish_us", "took_us"),
    "overhead_ms": overhead_ms,
    "metrics_summary": lambda spark, sf: O.metrics_summary(O.with_latency(_timed(spark, sf))),
    "sink_json": sink_json,
    "publish_envelopes": publish_envelopes,
    "stream_mask": stream_mask,
    "stream_restart": stream_restart,
    "stream_dedup": stream_dedup,
    "stream_retry": stream_retry,
}

_CUSTOMER = ("customers AS (SELECT c_custkey AS k, c_name AS name, "
             "substr(c_name, 1, CAST(c_custkey % 7 AS INT)) AS short FROM customer)")
_LISTS = (f"{_CUSTOMER},\nlists AS (SELECT k, ['a', name, 'b', 'a'] AS l, "
          "['b', short, concat('c', k % 3)] AS r FROM customers)")
_TIMED = """timed AS (SELECT event_id AS seq, concat('user-', user_id) AS session_name,
  CAST(round(value * 1000000) AS BIGINT) AS since_publish_us,
  CAST(round(value * 1000000) AS BIGINT) - CAST(round(value * 1000000) AS BIGINT) // 2 AS took_us,
  CASE event_type WHEN 'error' THEN 'model_error' WHEN 'view' THEN 'parse_error' ELSE 'ok' END AS disposition,
  CASE WHEN event_type = 'click' THEN user_id ELSE 0 END AS send_us, value, user_id FROM events)"""

def _answered_sql() -> str:
    """Outcome of the messages when recorded responses are used."""
    contents = CONTENTS.replace(I.TURNS + ",\n", "", 1)
    sent = I.ENVELOPES
    return (
        f"{sent},\n{contents},\n"
        "kept AS (SELECT session_id, count(*) AS n FROM (SELECT * FROM valid QUALIFY row_number() OVER "
        "(PARTITION BY session_id, value ORDER BY raw_key DESC) = 1) WHERE value <> '' AND value <> replacement GROUP BY session_id),\n"
        "stati AS (SELECT session_id, CASE WHEN content IS NULL THEN 'no_content' WHEN m IS NULL THEN 'unparsed' "
        "WHEN coalesce(n, 0) = 0 THEN 'none_found' ELSE 'found' END AS pair_status FROM maps LEFT JOIN kept USING (session_id)),\n"
        "policies AS (SELECT unnest(['quarantine', 'passthrough']) AS policy),\n"
        "judged AS (SELECT policy, coalesce(e.seq, 0) AS seq, nullif(header, '') AS session_name, payload, "
        "coalesce(CASE WHEN e.session_id % 5 <> 0 AND e.part = 0 THEN pair_status END, 'no_content') AS pair_status, "
        "CASE WHEN coalesce(header, '') = '' THEN 'no_session_name' WHEN payload <> body AND payload <> '[]' THEN 'parse_error' "
        "WHEN e.session_id % 5 = 0 OR e.part <> 0 THEN 'model_error' "
        "WHEN policy = 'quarantine' AND pair_status IN ('no_content', 'unparsed') THEN 'unusable_response' ELSE 'ok' END AS disposition "
        "FROM envelopes e JOIN log_bodies b ON e.session_id = b.session_id AND e.part = b.part "
        "JOIN stati s ON s.session_id = e.session_id CROSS JOIN policies)"
    )


_FIRST = "SELECT * FROM envelopes QUALIFY row_number() OVER (PARTITION BY session_id, part ORDER BY delivery) = 1"
ORACLES = {
    "kafka_columns": "SELECT event_id // 4 AS seq, event_type AS subject, CAST(event_id AS VARCHAR) AS k, "
                     "CAST(user_id % 4 AS VARCHAR) AS partition, CAST(event_id AS VARCHAR) AS payload FROM events",
    "first_delivery": "SELECT event_id // 4 AS seq, event_type AS subject, CAST(event_id AS VARCHAR) AS payload FROM events",
    "not_ready": "SELECT DISTINCT c_mktsegment AS component FROM customer WHERE NOT coalesce(c_acctbal > 9000, false)",
    "missing_rows": "SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 400000)",
    "mask_secret": f"WITH {_CUSTOMER}\nSELECT k, concat(substr(name, 1, 4), '****') AS name, "
                   "concat(substr(short, 1, 4), '****') AS short FROM customers",
    "mask_by_key": f"WITH {_CUSTOMER}\nSELECT k, concat(substr(name, 1, 4), '****') AS aws_key0, name AS aws_key1, "
                   "short AS other2, concat(substr(short, 1, 4), '****') AS aws_short3 FROM customers",
    "cut_at_marker": (
        f"WITH {_CUSTOMER},\nmessages AS (SELECT k, {_ERROR} AS message FROM customers)\n"
        "SELECT k, CASE WHEN regexp_matches(message, 'aws_request_id|s3_extended_request_id') THEN "
        "concat(regexp_extract(message, '^(.*?)(?:aws_request_id|s3_extended_request_id)', 1), '...') ELSE message END AS message FROM messages"),
    "preview": "SELECT doc_id, substr(text, 1, 80) AS head, CAST(least(strlen(text), 80) AS BIGINT) AS n_bytes FROM documents",
    "url_bucket": "SELECT page_id, NULL::VARCHAR AS web, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS stored, "
                  "NULL::VARCHAR AS empty FROM pages",
    "merge_unique": f"WITH {_LISTS}\nSELECT k, array_to_string(list_sort(list_distinct(list_concat(l, r))), '|') AS merged FROM lists",
    "missing_items": f"WITH {_LISTS}\nSELECT k, array_to_string(list_sort(list_distinct(list_filter(l, lambda x: NOT list_contains(r, x)))), '|') AS missing FROM lists",
    "disposition": f"WITH {_answered_sql()}\nSELECT policy, seq, session_name, disposition, disposition = 'ok' AS saved, "
                   "disposition IN ('no_session_name', 'model_error') AS retry, "
                   "CASE WHEN session_name IS NOT NULL THEN pair_status END AS pair_status FROM judged",
    "quarantine": f"WITH {_answered_sql()}\nSELECT seq, session_name, disposition, CAST(least(len(payload), 80) AS BIGINT) AS n_head "
                  "FROM judged WHERE policy = 'quarantine' AND disposition IN ('parse_error', 'unusable_response')",
    "latest_session": "SELECT concat('user-', user_id) AS session_name, event_id AS seq, event_type FROM events "
                      "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "metrics_rows": f"WITH {_TIMED}\nSELECT seq, session_name, send_us, '' AS storage, CAST(0 AS BIGINT) AS storage_us, "
                    "false AS memo_hit, since_publish_us, took_us FROM timed",
    "latency_us": f"WITH {_TIMED}\nSELECT seq, since_publish_us, took_us FROM timed",
    "overhead_ms": f"WITH {_TIMED}\nSELECT seq, round(value * 10 - CASE WHEN seq % 2 = 0 THEN user_id ELSE 0 END, 4) AS overhead_ms FROM timed",
    "metrics_summary": f"WITH {_TIMED}\nSELECT disposition, count(*) AS messages, min(since_publish_us) AS min_us, "
                       "max(since_publish_us) AS max_us, CAST(sum(since_publish_us) AS BIGINT) AS total_us FROM timed GROUP BY disposition",
    "latency_percentiles": f"WITH {_TIMED}\nSELECT disposition, quantile_disc(since_publish_us, 0.5) AS p50_us, "
                           "quantile_disc(since_publish_us, 0.95) AS p95_us FROM timed GROUP BY disposition",
    "sink_json": f"WITH {MESSAGES}\nSELECT session_name, seq, said FROM messages WHERE saved",
    "publish_envelopes": f"WITH {I.ENVELOPES}\nSELECT seq, subject, nullif(header, '') AS name, len(payload) AS n_chars FROM envelopes",
    "stream_mask": f"WITH {MESSAGES}\nSELECT session_name, seq, said FROM messages WHERE saved AND delivery = 1",
    "stream_restart": f"WITH {MESSAGES}\nSELECT session_name, count(*) AS n FROM messages WHERE saved AND delivery = 1 GROUP BY session_name",
    "stream_dedup": f"WITH {I.ENVELOPES},\nfirsts AS ({_FIRST})\nSELECT DISTINCT ON (coalesce(CAST(seq AS VARCHAR), "
                    "concat('#', coalesce(header, ''), payload))) seq, subject, len(payload) AS n_chars FROM firsts",
    "stream_retry": (
        f"WITH {MESSAGES},\nnameless AS (SELECT CASE WHEN seq = 0 THEN NULL ELSE seq END AS raw, seq FROM messages WHERE retry),\n"
        "runs AS (SELECT unnest([1, 2, 1]) AS attempts)\n"
        "SELECT seq, CAST(attempts AS BIGINT) AS attempts, 'outcomes' AS \"table\" FROM nameless CROSS JOIN runs "
        "UNION ALL SELECT seq, 2, 'gave_up' FROM nameless"),
}
