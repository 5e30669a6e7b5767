"""URL filter by rules and by trust that flows over the links between hosts.

Pages are judged by the longest rule that fits. Where none does, the host decides:
personalised PageRank carries trust from hosts along their links, and distrust against
the links, from the hosts that are linked to back to those that link to them. A host's
seed is the share of its pages that rules allow (trust) or block (distrust), so scores
mean the same for any number of hosts. A host is blocked when its distrust reaches
``THRESHOLD`` and exceeds its trust.

Everything is DataFrame code. Pages are summed up per host and links per pair of hosts
before they meet; rounds run on hosts, and every fifth is written to the shared folder,
so that plans stay short and lost executors cost little. A host with a third of all
pages or links is one key of hash aggregates with partial sums and of equi-joins that
adaptive execution can split.

Results: a null url, or one without ``://``, has empty host and path, fits no rule and
is allowed. Null html has no links. A rule's host fits all subdomains; among rules of
equal length the greater string wins. Repeated rows are judged alike. An empty table
gives an empty table. The rules that fit one host are held in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.llm.common import stored

DAMPING, ROUNDS, STORE_EVERY, THRESHOLD = 0.85, 20, 5, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of an absolute or protocol-relative link.
LINK = r"""[hH][rR][eE][fF][ \t\r\n]*=[ \t\r\n]*["']?(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"' \t\r\n>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def parse_rules(rules: list[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(verdict, ``host/path``) as (rule, host, path, verdict)."""
    out = []
    for verdict, rule in rules:
        host, _, path = rule.partition("/")
        out.append((rule, host.lower(), "/" + path, verdict))
    return out


def located(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    host, path = host_and_path(F.col("u"))
    return pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("u")).select(
        "page_id", host.alias("host"), path.alias("path"))


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and ``fit``, an array of the rules of the host and the domains above it."""
    most = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    labels = F.split("host", r"\.")
    suffix = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))),
        lambda k: F.array_join(F.slice(labels, -k, k), "."))).alias("rule_host"))
    return suffix.join(rules, "rule_host").groupBy("host").agg(
        F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "rule_path", "verdict")).alias("fit"))


def host_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Links between different hosts: src, dst and the shares they have of src's and of dst's links."""
    src, _ = host_and_path(F.col("u"))
    links = pages.select(F.coalesce(F.col(url_col), F.lit("")).alias("u"), F.col(html_col).alias("h")).select(
        src.alias("src"), F.explode(F.regexp_extract_all("h", F.lit(LINK), F.lit(1))).alias("dst"))
    counted = links.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    counted = stored(counted, "host-links")
    out = counted.groupBy("src").agg(F.sum("n").alias("out"))
    into = counted.groupBy("dst").agg(F.sum("n").alias("into"))
    return counted.join(out, "src").join(into, "dst").select(
        "src", "dst", (F.col("n") / F.col("out")).alias("forward"), (F.col("n") / F.col("into")).alias("backward"))


def propagate(seeds: DataFrame, links: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` from seeds (host, trust, distrust) over links.

    Scores are divided by 1 - damping, so that a host without links keeps its seed.
    """
    ends = links.select("src").unionAll(links.select("dst")).distinct().select(
        F.col("src").alias("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))
    hosts = seeds.unionAll(ends).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    seed = stored(hosts.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (kind, seed)")), "host-seeds")
    flows = stored(
        links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), F.col("forward").alias("share"))
        .unionAll(links.select(F.lit("distrust"), "dst", "src", "backward")), "host-flows")
    score = seed.withColumn("score", F.col("seed"))
    if not flows.isEmpty():
        for k in range(1, rounds + 1):
            sent = score.join(flows, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(
                F.sum(F.col("score") * F.col("share")).alias("got"))
            score = seed.join(sent, ["kind", "host"], "left").select(
                "kind", "host", "seed", (F.col("seed") + damping * F.coalesce("got", F.lit(0.0))).alias("score"))
            if k % STORE_EVERY == 0:
                score = stored(score, "host-scores")
    return score.groupBy("host").agg(
        F.max(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"),
        F.max(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"))


def judge_pages(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` of every page."""
    spark = pages.sparkSession
    table = spark.createDataFrame(parse_rules(rules), "rule string, rule_host string, rule_path string, verdict string")
    rows = located(pages, id_col, url_col)
    # Written, as the scores are, so that the joins have plain exchanges on both sides: only such joins are split at a hot host.
    fits = stored(fitting_rules(rows.select("host").distinct(), table), "host-rules")
    best = F.array_max(F.filter("fit", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    ruled = stored(
        rows.join(fits, "host", "left").withColumn("best", best)
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled")), "ruled-pages")
    share = lambda verdict: F.avg(F.when(F.col("ruled") == verdict, 1.0).otherwise(0.0))
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = stored(propagate(seeds, host_links(pages, url_col, html_col)), "host-verdicts")
    blocked = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def oracle_sql(rules: list[tuple[str, str]], threshold: float = THRESHOLD) -> str:
    """The same result in DuckDB SQL, with one common table per round."""
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    values = ", ".join(f"('{r}', '{h}', '{p}', '{v}')" for r, h, p, v in parse_rules(rules))
    link = LINK.replace("'", "''")
    steps = []
    for k in range(1, ROUNDS + 1):
        steps.append(f"""
        s{k} AS MATERIALIZED (
          SELECT seed.kind, seed.host, seed.seed, seed.seed + {DAMPING} * coalesce(g.got, 0) AS score
          FROM seed LEFT JOIN (
            SELECT kind, f.target AS host, sum(score * share) AS got FROM s{k - 1} JOIN flows f USING (kind, host) GROUP BY ALL
          ) g USING (kind, host))""")
    return f"""
      WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {values}),
      cut AS (
        SELECT page_id, html, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
      located AS MATERIALIZED (
        SELECT page_id, html, {lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
      ruled AS MATERIALIZED (
        SELECT page_id, host, path, html, (
          SELECT max(struct_pack(size := length(rule), rule := rule, verdict := verdict)) FROM rules
          WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best
        FROM located),
      shares AS (
        SELECT host, avg(CASE WHEN best.verdict = 'allow' THEN 1.0 ELSE 0.0 END)::DOUBLE AS trust,
               avg(CASE WHEN best.verdict = 'block' THEN 1.0 ELSE 0.0 END)::DOUBLE AS distrust
        FROM ruled WHERE host <> '' GROUP BY host),
      links AS MATERIALIZED (
        SELECT src, dst, count(*) AS n FROM (
          SELECT host AS src, {lower("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM located)
        WHERE src <> '' AND src <> dst GROUP BY ALL),
      weighted AS MATERIALIZED (
        SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS forward, n / sum(n) OVER (PARTITION BY dst) AS backward FROM links),
      flows AS MATERIALIZED (
        SELECT 'trust' AS kind, src AS host, dst AS target, forward AS share FROM weighted
        UNION ALL SELECT 'distrust', dst, src, backward FROM weighted),
      hosts AS (
        SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
          SELECT * FROM shares UNION ALL SELECT src, 0, 0 FROM links UNION ALL SELECT dst, 0, 0 FROM links) GROUP BY host),
      seed AS MATERIALIZED (
        SELECT 'trust' AS kind, host, trust AS seed FROM hosts UNION ALL SELECT 'distrust', host, distrust FROM hosts),
      s0 AS MATERIALIZED (SELECT kind, host, seed, seed AS score FROM seed),{",".join(steps)},
      scores AS (
        SELECT host, max(score) FILTER (kind = 'trust') AS trust, max(score) FILTER (kind = 'distrust') AS distrust
        FROM s{ROUNDS} GROUP BY host)
      SELECT page_id, host, path, best.rule AS rule,
             coalesce(best.verdict, CASE WHEN distrust >= {threshold} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
      FROM ruled LEFT JOIN scores USING (host)"""
