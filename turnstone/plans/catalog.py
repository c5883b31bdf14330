"""The registered queries: each operator on the driver's tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstone.functions import taxonomy, text
from turnstone.operators import containment, linkage, matching, relational, resolution, segmentation, temporal, verification
from turnstone.sources import html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MONEY = "decimal(18,4)"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
#: Classes of a note, in order; patterns without features that the two engines' dialects lack.
NOTES = [("secret", "(api_key|password|secret)"), ("contact", "[a-z0-9.]+@[a-z0-9]+"), ("licence", "(license|copyright|rights reserved)"), ("question", "[?]"), ("number", "[0-9]")]
FAMILIES = [("cheap", ["ECONOM", "PROMO"]), ("small", ["SMALL"]), ("large", ["LARGE", "MEDIUM"])]
LEAKS = [("licence", "All rights reserved|Licensed under"), ("markup", "<[a-z]+>"), ("symbols", "[#*$%&]{3}"), ("shout", "!!")]
ACCENTS = [text.ACCENTED, text.PLAIN]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _year(c: str):
    return F.year(F.col(c).cast("timestamp"))


def _day(c: str):
    return F.to_date(F.col(c).cast("timestamp"))


def letters_sql(c: str) -> str:
    return f"regexp_replace(strip_accents(replace(lower({c}), 'ß', 'ss')), '[^0-9a-z]', '', 'g')"


# --- joins, pivots, shares ---------------------------------------------------


@query("""SELECT year(o_orderdate) AS year, """ + ", ".join(f"CAST(coalesce(sum(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(18,4)) END), 0) AS DOUBLE) AS p{k}" for k, p in enumerate(PRIORITIES, 1)) + " FROM orders GROUP BY 1")
def sum_pivot_by_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", _year("o_orderdate"))
    names = [f"p{k}" for k in range(1, 6)]
    got = relational.pivot_sum(orders, "year", "o_orderpriority", PRIORITIES, F.col("o_totalprice").cast(MONEY), names)
    return got.select("year", *[F.col(n).cast("double").alias(n) for n in names])


@query("SELECT role, CAST(sum(len(regexp_extract_all(text, '[^\\s]+'))) AS BIGINT) AS words, count(*) AS n FROM conversations GROUP BY role")
def passages_word_count(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.sum(text.word_count(F.col("text"))).alias("words"), F.count("*").alias("n"))


@query("""SELECT n_name, l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def speaker_enrich_left_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    who = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    where = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    got = relational.enrich(relational.enrich(lines, who, ["l_suppkey"]), where, ["s_nationkey"])
    return got.groupBy("n_name", "l_returnflag").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("quantity"))


@query("""WITH s AS (SELECT year(o_orderdate) AS year, o_orderpriority, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS v FROM orders GROUP BY ALL)
SELECT year, o_orderpriority, round(100 * CAST(v AS DOUBLE) / CAST(sum(v) OVER (PARTITION BY year) AS DOUBLE), 6) AS share FROM s""")
def pivot_share_by_period(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", _year("o_orderdate"))
    return relational.share_within(orders, "year", "o_orderpriority", F.col("o_totalprice").cast(MONEY), "share")


@query("""SELECT CAST(ts AS DATE) AS day, """ + ", ".join(f"count(DISTINCT CASE WHEN event_type = '{t}' THEN user_id END) AS n_{t}" for t in ("view", "click", "purchase", "signup", "error")) + ", count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
def sittings_per_period_distinct(spark, sf_dir):
    kinds = ["view", "click", "purchase", "signup", "error"]
    events = table(spark, sf_dir, "events").withColumn("day", _day("ts"))
    return relational.distinct_per(events, "day", "event_type", kinds, "user_id", [f"n_{k}" for k in kinds], "n_users")


@query("""SELECT role, round(sum(len(regexp_extract_all(text, '[^\\s]+'))) / count(DISTINCT conv_id), 6) AS words_per_session FROM conversations GROUP BY role""")
def words_per_session_ratio(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations")
    words = talk.groupBy("role").agg(F.sum(text.word_count(F.col("text"))).alias("words"))
    held = talk.groupBy("role").agg(F.countDistinct("conv_id").alias("held"))
    return words.join(held, "role").select("role", F.round(F.col("words") / F.col("held"), 6).alias("words_per_session"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY 1),
e AS (SELECT CAST(ts AS DATE) AS day, count(*) AS errors FROM events WHERE event_type = 'error' AND value > 90 GROUP BY 1)
SELECT day, round(errors * 10000.0::DOUBLE / views, 6) AS rate FROM d LEFT JOIN e USING (day)""")
def event_rate_per_10k(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(_day("ts").alias("day"), "event_type", "value")
    base = events.where("event_type = 'view'").groupBy("day").agg(F.count("*").alias("views"))
    hits = events.where("event_type = 'error' AND value > 90").groupBy("day").agg(F.count("*").alias("errors"))
    return relational.rate_from(base, hits, "day", "errors", "views", 10000.0, "rate")


@query("""SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS total, min(year(o_orderdate)) AS first, max(year(o_orderdate)) AS last
FROM orders GROUP BY 1 ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,4))) DESC, 1 LIMIT 20""")
def top_speakers_span(spark, sf_dir):
    got = relational.top_with_span(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_totalprice").cast(MONEY), _year("o_orderdate"), 20)
    return got.withColumn("total", F.col("total").cast("double"))


@query("""SELECT o_orderstatus, round(100 * CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) FROM orders), 6) AS share FROM orders GROUP BY 1""")
def status_share_report(spark, sf_dir):
    return relational.share_of_total(table(spark, sf_dir, "orders"), "o_orderstatus", F.col("o_totalprice").cast(MONEY), "share")


@query("SELECT lang, " + ", ".join(f"round(quantile_cont(n_chars, {q}), 6) AS {n}" for n, q in (("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95))) + " FROM documents GROUP BY lang")
def exact_quantiles(spark, sf_dir):
    names = ["p05", "p25", "p50", "p75", "p95"]
    got = relational.quantiles(table(spark, sf_dir, "documents"), "lang", "n_chars", [0.05, 0.25, 0.5, 0.75, 0.95], names)
    return got.select("lang", *[F.round(n, 6).alias(n) for n in names])


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS k FROM c) SELECT user_id, event_type AS mode, n FROM r WHERE k = 1""")
def mode_of_group(spark, sf_dir):
    return relational.mode_first(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_values FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def fd_check(spark, sf_dir):
    return relational.broken_dependencies(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query("SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def unique_key_check(spark, sf_dir):
    return relational.repeated_keys(table(spark, sf_dir, "orders").withColumn("day", _day("o_orderdate")), ["o_custkey", "day"])


# --- text ---------------------------------------------------------------------


def _case(column: str, rules: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{n}'" for n, p in rules) + f" ELSE '{default}' END"


@query(f"SELECT doc_id, {_case('lower(text)', NOTES, 'unspecified')} AS event_type FROM documents")
def event_classify_ordered(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", taxonomy.first_match(F.lower("text"), NOTES, "unspecified").alias("event_type"))


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN {' OR '.join(f'contains(p_type, {chr(39)}{w}{chr(39)})' for w in ws)} THEN '{n}'" for n, ws in FAMILIES) + " ELSE 'other' END AS family FROM part")
def family_bucket(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", taxonomy.first_contained(F.col("p_type"), FAMILIES, "other").alias("family"))


@query("""SELECT c_custkey, lower(regexp_replace(trim(regexp_replace(c_name, '\\s+', ' ', 'g')), '[\\s.\\-–—−:]+$', '')) AS label,
substr(lower(trim(regexp_replace(regexp_replace(c_name, '^[^\\p{L}\\p{N}_]+', ''), '\\s+', ' ', 'g'))), 1, 12) AS opening FROM customer""")
def label_normalize(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.label_key(F.col("c_name")).alias("label"), text.opening_key(F.col("c_name"), 12).alias("opening"))


@query(f"SELECT doc_id, sha256({letters_sql('text')}) AS digest, CAST(length({letters_sql('text')}) AS BIGINT) AS n FROM documents")
def fold_text(spark, sf_dir):
    folded = text.letters_and_digits(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(folded, 256).alias("digest"), F.length(folded).cast("long").alias("n"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(lower(substr(text, 1, 4000)), '(license|copyright)') THEN true
WHEN regexp_matches(lower(substr(text, 1, 4000)), '[!?]') THEN false END AS status FROM documents""")
def head_status_three_valued(spark, sf_dir):
    head = F.lower(F.substring("text", 1, 4000))
    return table(spark, sf_dir, "documents").select("doc_id", taxonomy.three_valued(head, "(license|copyright)", "[!?]").alias("status"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS pattern, count(*) FILTER (WHERE regexp_matches(text, '{p}')) AS n_rows FROM documents" for n, p in LEAKS))
def leakage_patterns(spark, sf_dir):
    return containment.leak_counts(table(spark, sf_dir, "documents"), "text", LEAKS)


# --- HTML ---------------------------------------------------------------------


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS body FROM pages""")
def html_readable_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.readable(F.col("html")).alias("body"))


@query("""SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)) AS BIGINT) AS n_links,
array_to_string(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1), ' ') AS targets FROM pages""")
def html_links(spark, sf_dir):
    found = html.links(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.size(found).cast("long").alias("n_links"), F.array_join(found, " ").alias("targets"))


@query()
def html_paragraphs(spark, sf_dir):
    got = html.paragraphs(table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    p = F.col("paragraph")
    return got.select("page_id", "para", html.paragraph_text(p).alias("text"), html.italic_share(p).alias("italic"), p["listitem"].alias("listitem"), p["link_only"].alias("link_only"))


# --- turns and spells -----------------------------------------------------------

_TURNS = """SELECT event_id, user_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER w AS n,
last_value(CASE WHEN event_type = 'signup' THEN true WHEN event_type = 'error' THEN false END IGNORE NULLS) OVER w AS s
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


@query(f"SELECT event_id, user_id, CASE WHEN s THEN CAST(n AS BIGINT) END AS turn_id FROM ({_TURNS})")
def turns_from_labels(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return segmentation.turns(events, "user_id", ["ts", "event_id"], F.col("event_type") == "signup", F.col("event_type") == "error").select("event_id", "user_id", "turn_id")


_RUNS = """SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM
(SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS new FROM events)"""


@query(f"SELECT user_id, event_type, min(CAST(ts AS DATE)) AS begin, max(CAST(ts AS DATE)) AS \"end\", count(*) AS n FROM ({_RUNS}) GROUP BY user_id, event_type, run")
def spells(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", _day("ts").alias("day"))
    return temporal.spells(events, "user_id", ["ts", "event_id"], "event_type", "day")


@query(f"""SELECT user_id, min(event_id) AS event_id, event_type, count(*) AS n_rows, string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) AS ids
FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM
(SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, event_type, run""")
def consolidate_adjacent(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("event_id").cast("string").alias("ids"))
    return segmentation.consolidated(events, "user_id", "event_id", ["event_type"], "ids")


_LIVES = "(VALUES ('signup', DATE '2024-01-08', DATE '2024-01-20', 'click'), ('error', NULL, DATE '2024-01-15', NULL), ('view', DATE '2024-01-10', NULL, 'signup')) AS l(event_type, life_begin, life_end, predecessor)"


@query(f"""WITH s AS (SELECT user_id, event_type, min(CAST(ts AS DATE)) AS b, max(CAST(ts AS DATE)) AS e, count(*) AS n FROM ({_RUNS}) GROUP BY user_id, event_type, run),
j AS (SELECT s.*, l.life_begin, l.life_end, l.predecessor FROM s LEFT JOIN {_LIVES} USING (event_type))
SELECT user_id, n, event_type, greatest(b, coalesce(life_begin, b)) AS begin, least(e, coalesce(life_end, e)) AS "end" FROM j WHERE greatest(b, coalesce(life_begin, b)) <= least(e, coalesce(life_end, e))
UNION ALL SELECT user_id, n, predecessor, b, least(e, life_begin) FROM j WHERE predecessor IS NOT NULL AND life_begin IS NOT NULL AND b < life_begin""")
def spells_clipped(spark, sf_dir):
    lives = spark.sql(f"SELECT * FROM {_LIVES}")
    got = temporal.clipped(spells(spark, sf_dir), lives, "event_type")
    return got.select("user_id", "n", "event_type", "begin", "end")


@query(f"""SELECT event_id, event_type, coalesce(bool_or((life_begin IS NULL OR life_begin <= CAST(ts AS DATE)) AND (life_end IS NULL OR CAST(ts AS DATE) <= life_end)) FILTER (WHERE l.event_type IS NOT NULL), true) AS alive
FROM events e LEFT JOIN {_LIVES} USING (event_type) GROUP BY event_id, event_type""".replace("FILTER (WHERE l.event_type IS NOT NULL)", "FILTER (WHERE coalesce(life_begin, life_end) IS NOT NULL)"))
def validity_check(spark, sf_dir):
    lives = spark.sql(f"SELECT event_type, life_begin, life_end FROM {_LIVES}")
    probes = table(spark, sf_dir, "events").select("event_id", "event_type", _day("ts").alias("day"))
    return temporal.alive(probes, lives, "event_type", "day").select("event_id", "event_type", "alive")


# --- as-of --------------------------------------------------------------------

_PROBES = "SELECT event_id AS probe, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error'"
_READINGS = "SELECT user_id, CAST(ts AS DATE) AS seen, event_type AS value FROM events WHERE event_type IN ('signup', 'purchase')"


def _asof(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", _day("ts").alias("day"), "event_type")
    probes = events.where("event_type = 'error'").select(F.col("event_id").alias("probe"), "user_id", "day")
    return probes, events.where("event_type IN ('signup', 'purchase')").select("user_id", F.col("day").alias("seen"), F.col("event_type").alias("value"))


@query(f"""WITH p AS ({_PROBES}), r AS ({_READINGS}),
m AS (SELECT probe, seen, value, abs(seen - day) AS gap, row_number() OVER (PARTITION BY probe ORDER BY abs(seen - day), seen, value) AS k FROM p JOIN r USING (user_id) WHERE abs(seen - day) <= 2)
SELECT p.probe, p.user_id, p.day, m.seen, m.value, CAST(m.gap AS INT) AS gap FROM p LEFT JOIN m ON p.probe = m.probe AND m.k = 1""")
def asof_nearest(spark, sf_dir):
    return temporal.asof_nearest(*_asof(spark, sf_dir), "user_id", "day", "seen", "value", 2)


@query(f"""WITH p AS ({_PROBES}), r AS ({_READINGS}),
b AS (SELECT probe, max({{'s': seen, 'v': value}}) AS x FROM p JOIN r USING (user_id) WHERE seen <= day GROUP BY 1),
a AS (SELECT probe, min({{'s': seen, 'v': value}}) AS x FROM p JOIN r USING (user_id) WHERE seen >= day GROUP BY 1)
SELECT p.probe, b.x.v AS before, a.x.v AS after, coalesce(b.x.v <> a.x.v, false) AS disputed FROM p LEFT JOIN b USING (probe) LEFT JOIN a USING (probe)""")
def asof_disputed(spark, sf_dir):
    got = temporal.before_and_after(*_asof(spark, sf_dir), "user_id", "day", "seen", "value")
    return got.select("probe", F.col("before.value").alias("before"), F.col("after.value").alias("after"), F.coalesce(F.col("before.value") != F.col("after.value"), F.lit(False)).alias("disputed"))


@query(f"""WITH p AS ({_PROBES}), r AS ({_READINGS}),
b AS (SELECT probe, max({{'s': seen, 'v': value}}) AS x FROM p JOIN r USING (user_id) WHERE seen <= day GROUP BY 1),
a AS (SELECT probe, min({{'s': seen, 'v': value}}) AS x FROM p JOIN r USING (user_id) WHERE seen >= day GROUP BY 1)
SELECT p.probe, b.x.v AS value, CAST(least(p.day - b.x.s, a.x.s - p.day) AS INT) AS gap, CAST(a.x.s - b.x.s AS INT) AS span FROM p JOIN b USING (probe) JOIN a USING (probe) WHERE b.x.v = a.x.v AND p.day - b.x.s > 0 AND a.x.s - p.day > 0""")
def asof_bracketed(spark, sf_dir):
    probes, readings = _asof(spark, sf_dir)
    got = temporal.before_and_after(probes, readings, "user_id", "day", "seen", "value").join(probes.select("probe", "day"), "probe")
    back, ahead = F.datediff("day", F.col("before.seen")), F.datediff(F.col("after.seen"), "day")
    return got.where((F.col("before.value") == F.col("after.value")) & (back > 0) & (ahead > 0)).select("probe", F.col("before.value").alias("value"), F.least(back, ahead).alias("gap"), F.datediff(F.col("after.seen"), F.col("before.seen")).alias("span"))


# --- linkage --------------------------------------------------------------------

_PROBE_NAMES = "SELECT n_nationkey AS probe, lower(CASE n_nationkey % 4 WHEN 0 THEN n_name || ' of land_' || n_nationkey WHEN 1 THEN n_name WHEN 2 THEN 'land_' || n_nationkey ELSE 'of ' || n_name END) AS key FROM nation"
_TARGET_NAMES = "SELECT n_nationkey AS target, lower(n_name || ' of land_' || n_nationkey) AS name FROM nation"


@query(f"""WITH p AS ({_PROBE_NAMES}), t AS ({_TARGET_NAMES}),
e AS (SELECT probe, min(target) AS target FROM p JOIN t ON key = name GROUP BY 1 HAVING count(DISTINCT target) = 1),
p2 AS (SELECT * FROM p WHERE probe NOT IN (SELECT probe FROM e)),
x AS (SELECT probe, min(target) AS target FROM p2 JOIN t ON name = key OR starts_with(name, key || ' ') OR starts_with(key, name || ' ') GROUP BY 1 HAVING count(DISTINCT target) = 1),
p3 AS (SELECT * FROM p2 WHERE probe NOT IN (SELECT probe FROM x)),
y AS (SELECT probe, min(target) AS target FROM p3 JOIN t ON name = key OR ends_with(name, ' ' || key) GROUP BY 1 HAVING count(DISTINCT target) = 1)
SELECT *, 'exact' AS rung FROM e UNION ALL SELECT *, 'prefix' FROM x UNION ALL SELECT *, 'suffix' FROM y""")
def cascade_match(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    targets = spark.sql(_TARGET_NAMES.replace("FROM nation", "FROM {nation}"), nation=nation)
    return linkage.cascade_match(spark.sql(_PROBE_NAMES.replace("FROM nation", "FROM {nation}"), nation=nation), targets, "probe", "key", "target", "name")


@query()
def fuzzy_rung(spark, sf_dir):
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("target"))
    names = names.select("target", F.col("p_name").alias("name"))
    probes = names.select(F.col("target").alias("probe"), F.concat(F.substring("name", 1, 3), F.lit("x"), F.substring("name", 4, 40)).alias("key"))
    return linkage.fuzzy_match(probes, names, "probe", "key", "target", "name")


@query("""WITH s AS (SELECT source, sum(n_chars) AS n, sum(CASE WHEN lang = 'en' THEN n_chars ELSE 0 END) AS y FROM documents GROUP BY 1)
SELECT source, CAST(n AS BIGINT) AS n, y / n >= 0.6 AS flag FROM s WHERE n >= 4 AND (y / n >= 0.6 OR y / n <= 1 - 0.6)""")
def learned_flags(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", (F.col("lang") == "en").alias("flag"), "n_chars")
    return linkage.learned_flags(docs, "source", "flag", "n_chars", 4, 0.6)


_LABELS = "SELECT s_suppkey, s_name, CASE s_suppkey % 4 WHEN 0 THEN 'Varios señores' WHEN 1 THEN 'Sr. ' || s_name WHEN 2 THEN 'Sra.' || s_name || '.-' ELSE 'Sr. Presidente' END AS label FROM supplier"


@query(f"""WITH l AS ({_LABELS}) SELECT DISTINCT label, CASE s_suppkey % 4 WHEN 0 THEN 'collective' WHEN 3 THEN 'office_only' ELSE 'matched_senator' END AS match_status,
CASE WHEN s_suppkey % 4 IN (1, 2) THEN 'p' || s_suppkey END AS person_id, CASE WHEN s_suppkey % 4 IN (1, 2) THEN 'n' || s_nationkey END AS province FROM l JOIN supplier USING (s_suppkey)""")
def resolve_labels(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    day = F.lit("2010-05-01").cast("date")
    printed = spark.sql(_LABELS.replace("FROM supplier", "FROM {supplier}"), supplier=suppliers)
    printed = printed.select("label", day.alias("day"), F.lit("1").alias("session"), F.lit("ORDINARIA").alias("session_type"), F.lit(None).cast("array<string>").alias("presiding"))
    nothing = F.lit(None).cast("string")
    members = suppliers.select(F.concat(F.lit("p"), "s_suppkey").alias("person_id"), F.col("s_name").alias("surname"), F.lit("X").alias("given"), nothing.alias("party"), F.concat(F.lit("n"), "s_nationkey").alias("province"), day.alias("begin"), F.lit(None).cast("date").alias("end"), F.col("s_suppkey").alias("load_order"))
    officers = table(spark, sf_dir, "nation").select(F.concat(F.lit("auth:"), "n_nationkey").alias("person_id"), F.col("n_name").alias("name"), F.array(text.resolver_key(F.col("n_name"))).alias("keys"), F.lit("secretaria").alias("role_stem"), F.lit("chamber").alias("category"), day.alias("begin"), F.lit(None).cast("date").alias("end"), F.lit(True).alias("curated"), F.col("n_nationkey").cast("long").alias("load_order"))
    return resolution.resolve(printed, members, officers).select("label", "match_status", "person_id", "province")


@query("""WITH m AS (SELECT s_suppkey, s_nationkey, s_suppkey % 2 = 0 AS feminine FROM supplier),
own AS (SELECT 'Sr' || CASE WHEN feminine THEN 'a' ELSE '' END || '. House' || s_nationkey || ' (Giv' || s_suppkey || ')' AS label, 4 AS n, 'matched_senator' AS match_status, 'p' || s_suppkey AS person_id, NULL AS tiebreak FROM m),
house AS (SELECT s_nationkey, feminine, count(*) OVER (PARTITION BY s_nationkey) AS seats, count(*) OVER (PARTITION BY s_nationkey, feminine) AS alike, s_suppkey FROM m),
bare AS (SELECT 'Sr' || CASE WHEN feminine THEN 'a' ELSE '' END || '. House' || s_nationkey AS label, count(*) AS n, CASE WHEN max(seats) = 1 OR count(*) = 1 THEN 'matched_senator' ELSE 'ambiguous' END AS match_status,
 CASE WHEN max(seats) = 1 OR count(*) = 1 THEN 'p' || min(s_suppkey) END AS person_id, CASE WHEN max(seats) > 1 AND count(*) = 1 THEN 'honorific' END AS tiebreak FROM house GROUP BY s_nationkey, feminine)
SELECT label, CAST(n AS BIGINT) AS n, match_status, person_id, tiebreak FROM (SELECT * FROM own UNION ALL SELECT * FROM bare)""")
def resolve_twice(spark, sf_dir):
    day, title = F.lit("2010-05-01").cast("date"), F.concat(F.lit("Sr"), F.when(F.col("s_suppkey") % 2 == 0, "a").otherwise(""), F.lit(". House"), F.col("s_nationkey"))
    given, nothing = F.concat(F.lit("Giv"), "s_suppkey"), F.lit(None).cast("string")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    own = F.array_repeat(F.concat(title, F.lit(" ("), given, F.lit(")")), 4)
    printed = suppliers.select(F.explode(F.concat(own, F.array(title))).alias("label"), day.alias("day"), F.lit("1").alias("session"), F.lit("ORDINARIA").alias("session_type"), F.lit(None).cast("array<string>").alias("presiding"))
    members = suppliers.select(F.concat(F.lit("p"), "s_suppkey").alias("person_id"), F.concat(F.lit("House"), "s_nationkey").alias("surname"), given.alias("given"), nothing.alias("party"), nothing.alias("province"), day.alias("begin"), F.lit(None).cast("date").alias("end"), F.col("s_suppkey").alias("load_order"))
    officers = table(spark, sf_dir, "nation").select(F.concat(F.lit("auth:"), "n_nationkey").alias("person_id"), F.col("n_name").alias("name"), F.array(text.resolver_key(F.col("n_name"))).alias("keys"), F.lit("secretaria").alias("role_stem"), F.lit("chamber").alias("category"), day.alias("begin"), F.lit(None).cast("date").alias("end"), F.lit(True).alias("curated"), F.col("n_nationkey").cast("long").alias("load_order"))
    return resolution.resolve_twice(printed, members, officers).select("label", "n", "match_status", "person_id", "tiebreak")


@query("""WITH f AS (SELECT sha256(text) AS passage, bool_and(role = 'user') AS u, bool_and(role = 'assistant') AS a, bool_and(role = 'system') AS s FROM conversations WHERE text IS NOT NULL GROUP BY 1)
SELECT conv_id, turn, CASE WHEN CASE role WHEN 'user' THEN u WHEN 'assistant' THEN a ELSE s END THEN 'holds' ELSE 'several' END AS verdict FROM conversations JOIN f ON sha256(text) = passage""")
def read_verdicts(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").where("text IS NOT NULL").select("conv_id", "turn", "role", F.sha2("text", 256).alias("passage"))
    found = talk.groupBy("passage").agg(F.collect_set("role").alias("found"))
    return talk.join(found, "passage").select("conv_id", "turn", verification.verdict(F.col("role"), F.col("found")).alias("verdict"))


# --- set operations ---------------------------------------------------------------


@query("""SELECT user_id AS id, CAST(ts AS DATE) AS day, event_type AS what, CASE WHEN event_type = 'error' THEN 'weak' ELSE 'firm' END AS grade FROM events
UNION ALL SELECT o_custkey, CAST(o_orderdate AS DATE), o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'firm' ELSE 'weak' END FROM orders
UNION ALL SELECT l_suppkey, CAST(l_shipdate AS DATE), l_returnflag, 'deduced' FROM lineitem""")
def observations_union(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), _day("ts").alias("day"), F.col("event_type").alias("what"), F.when(F.col("event_type") == "error", "weak").otherwise("firm").alias("grade"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), _day("o_orderdate").alias("day"), F.col("o_orderstatus").alias("what"), F.when(F.col("o_orderstatus") == "F", "firm").otherwise("weak").alias("grade"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id"), _day("l_shipdate").alias("day"), F.col("l_returnflag").alias("what"), F.lit("deduced").alias("grade"))
    return relational.union_all(events, orders, lines)


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, CAST(ts AS DATE) AS day FROM events),
n AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY 1),
o AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09' GROUP BY 1)
SELECT * FROM n UNION ALL SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM n)""")
def upsert_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", _day("ts"))
    version = lambda day: events.where(F.col("day") == F.lit(day).cast("date")).groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return relational.upsert(version("2024-01-09"), version("2024-01-10"), ["user_id"])


@query("""SELECT c_custkey AS key, 'missing' AS side FROM customer WHERE c_custkey NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT DISTINCT doc_id, 'extra' FROM documents WHERE doc_id NOT IN (SELECT c_custkey FROM customer)""")
def missing_and_extra(spark, sf_dir):
    listed = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return relational.missing_and_extra(listed, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key")), "key")


@query("""WITH a AS (SELECT c_nationkey AS nation, count(*) AS ours FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS nation, count(*) AS theirs FROM supplier GROUP BY 1)
SELECT nation, coalesce(ours, 0) AS ours, coalesce(theirs, 0) AS theirs, coalesce(ours, 0) - coalesce(theirs, 0) AS difference FROM a FULL JOIN b USING (nation)""")
def count_reconcile(spark, sf_dir):
    ours = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return relational.reconcile(ours, table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")), "nation")


@query("""WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS x FROM orders GROUP BY ALL), b AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS y FROM lineitem GROUP BY ALL)
SELECT year(day) AS year, CAST(sum(least(x, y)) AS BIGINT) AS overlap FROM a JOIN b USING (day) GROUP BY 1""")
def multiset_overlap(spark, sf_dir):
    days = lambda name, c: table(spark, sf_dir, name).select(_year(c).alias("year"), _day(c).alias("day"))
    return relational.multiset_overlap(days("orders", "o_orderdate"), days("lineitem", "l_shipdate"), ["day"], ["year"])


_RULE = "regexp_matches(text, '[#*$%&|]|!!')"


@query(f"""WITH s AS (SELECT count(*) FILTER (WHERE quality = 0 AND {_RULE}) AS tp, count(*) FILTER (WHERE {_RULE}) AS f, count(*) FILTER (WHERE quality = 0) AS g FROM documents JOIN labels USING (doc_id)),
q AS (SELECT tp / greatest(f, 1) AS p, tp / greatest(g, 1) AS r FROM s) SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM q""")
def rule_precision_recall(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id", F.col("text").rlike("[#*$%&|]|!!").alias("found")).join(table(spark, sf_dir, "labels"), "doc_id")
    sums = both.agg(F.count_if(F.col("found") & (F.col("quality") == 0)).alias("tp"), F.count_if("found").alias("found"), F.count_if(F.col("quality") == 0).alias("gold"))
    return sums.select(*relational.precision_recall(F.col("tp"), F.col("found"), F.col("gold")))


@query("""SELECT round(2.0::DOUBLE * count(*) FILTER (WHERE quality = 0 AND toxic = 1) / (count(*) FILTER (WHERE quality = 0) + count(*) FILTER (WHERE toxic = 1)), 6) AS agreement FROM labels""")
def agreement_of_readings(spark, sf_dir):
    sums = table(spark, sf_dir, "labels").agg(F.count_if((F.col("quality") == 0) & (F.col("toxic") == 1)).alias("s"), F.count_if(F.col("quality") == 0).alias("a"), F.count_if(F.col("toxic") == 1).alias("b"))
    return sums.select(relational.agreement(F.col("s"), F.col("a"), F.col("b")).alias("agreement"))


@query()
def max_matching(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "role", F.lit("").alias("label"), F.lower("text").alias("opening"))
    asks = F.col("role") == "user"
    return matching.matched(talk.where(asks), talk.where(~asks | F.col("role").isNull()), "conv_id", "label", "opening")


# --- containment -------------------------------------------------------------------

_WINDOWS = """SELECT item_id, unnest(list_distinct([substr(f, 11, 40), substr(f, greatest(10, (length(f) - 40) // 2) + 1, 40), substr(f, greatest(10, length(f) - 41) + 1, 40)])) AS probe FROM i WHERE length(f) >= 52"""


@query(f"""WITH i AS (SELECT item_id, {letters_sql('text')} AS f FROM benchmark), w AS ({_WINDOWS}), d AS (SELECT doc_id, {letters_sql('text')} AS t FROM documents)
SELECT DISTINCT item_id, doc_id FROM w JOIN d ON contains(t, probe)""")
def probe_containment(spark, sf_dir):
    return containment.contained(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")


@query()
def reconstruct_cover(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source")), table(spark, sf_dir, "benchmark")
    found = containment.contained(items, table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")
    return containment.reconstructed(found.join(docs, "doc_id").join(items, "item_id"), "text", "source").select("item_id", "doc_id", "rebuilt")


_SIGNATURE = letters_sql("line").replace("[^0-9a-z]", "[^a-z]")


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), s AS (SELECT DISTINCT doc_id, {_SIGNATURE} AS signature FROM l)
SELECT signature, count(*) AS n_docs FROM s WHERE length(signature) >= 12 GROUP BY 1 HAVING count(*) >= 3""")
def repeated_header_lines(spark, sf_dir):
    return containment.repeated_lines(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, sf_dir):
    return relational.exact_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT doc_id, row_number() OVER (PARTITION BY lang, sha256(text) ORDER BY doc_id) AS nth, count(*) OVER (PARTITION BY lang, sha256(text)) AS of FROM documents")
def nth_occurrence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("digest"))
    return relational.occurrence(docs, ["lang", "digest"], ["doc_id"]).select("doc_id", "nth", "of")


@query("""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(concat_ws('|', 'sheet', CAST(doc_id AS VARCHAR))), doc_id) AS k FROM documents) SELECT doc_id, lang FROM r WHERE k <= 7""")
def stable_stratified_sample(spark, sf_dir):
    return relational.stable_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", ["doc_id"], "sheet", 7)


@query("""SELECT conv_id, turn, role, lag(role) OVER w AS before, coalesce(role = lag(role) OVER w, false) AS repeats FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def turn_shape_faults(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.lag("role").over(w).alias("before"))
    return talk.withColumn("repeats", F.coalesce(F.col("role") == F.col("before"), F.lit(False)))


@query("""WITH q AS (SELECT n_nationkey AS nation, count(s_suppkey) AS held FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1), m AS (SELECT max(held) AS top FROM q)
SELECT nation, held, top - held AS room FROM q, m WHERE top - held > 0""")
def residual_capacity(spark, sf_dir):
    held = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("n_nationkey").alias("nation")).agg(F.count("s_suppkey").alias("held"))
    return held.join(F.broadcast(held.agg(F.max("held").alias("top")))).withColumn("room", F.col("top") - F.col("held")).where("room > 0").select("nation", "held", "room")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with how many documents hold each."""
    return probe_containment(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"))
