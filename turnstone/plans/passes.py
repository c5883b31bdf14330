"""Queries of the block passes, placement and caucus rules on the driver's tables, with their SQL.

Turns of ``conversations`` stand for a document's blocks, lines of an order in ``lineitem`` for
its characters, ``events`` and ``orders`` for dated readings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from turnstone.operators import caucus, passes, placement, segmentation, transcript
from turnstone.plans.catalog import query, table
from turnstone.sources import html

_WORDY = "substr(regexp_replace(text, '\\s+', ' ', 'g'), 1, 60)"


def blocks(spark, sf_dir):
    """Conversations as blocks: assistants' turns are bold, users' italic or normal by place; size by place."""
    c = table(spark, sf_dir, "conversations")
    style = F.when(F.col("role") == "assistant", "bold").when(F.col("turn") % 3 == 0, "italic").otherwise("normal")
    return c.select("conv_id", "turn", "role", "text", style.alias("style"), F.when(F.col("turn") % 4 == 3, 10.0).otherwise(12.0).alias("size"))


_BLOCKS = "b AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'assistant' THEN 'bold' WHEN turn % 3 = 0 THEN 'italic' ELSE 'normal' END AS style, CASE WHEN turn % 4 = 3 THEN 10.0 ELSE 12.0 END AS size FROM conversations)"


def digest(df, *names, text="text"):
    """Texts as lengths and checksums, so that results stay small."""
    return df.select(*names, F.length(text).alias("n"), F.md5(F.col(text)).alias("digest"))


# --- characters ---------------------------------------------------------------


@query("""WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_quantity) AS rank, sum(n) OVER (PARTITION BY l_suppkey) AS total FROM c)
SELECT l_suppkey, rank, l_quantity FROM r WHERE rank <= 3 AND (n >= 0.05 * total OR rank = 1)""")
def body_size_candidates(spark, sf_dir):
    return passes.body_sizes(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", F.col("l_returnflag") == "N")


@query("""WITH m AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR value > 20 IS DISTINCT FROM lag(value > 20) OVER w OR lag(1) OVER w IS NULL THEN 1 ELSE 0 END AS new
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM m)
SELECT user_id, event_type, value > 20 AS large, min(event_id) AS event_id, count(*) AS n_rows, string_agg(substr(event_type, 1, 1), '' ORDER BY event_id) AS chars FROM r GROUP BY user_id, run, event_type, value > 20""")
def style_runs(spark, sf_dir):
    chars = table(spark, sf_dir, "events").withColumns({"chars": F.substring("event_type", 1, 1), "large": F.col("value") > 20})
    return segmentation.run_grouped(chars, "user_id", "event_id", ["event_type", "large"], "chars")


@query("""SELECT user_id, event_id, coalesce(value > 0.15 * 300 OR (event_type <> lag(event_type) OVER w AND lag(props) OVER w NOT IN ('-', '‐')) OR event_id % 7 <> lag(event_id % 7) OVER w, false) AS space
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def missing_spaces(spark, sf_dir):
    own = table(spark, sf_dir, "events").withColumn("page", F.col("event_id") % 7)
    space = segmentation.missing_space("user_id", "event_id", F.col("value"), F.lit(300), "event_type", "page", "props")
    return own.select("user_id", "event_id", space.alias("space"))


_EDGE = """WITH e AS (SELECT *, {agg}(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) OVER (PARTITION BY l_orderkey) AS edge FROM lineitem)
SELECT l_orderkey, count(*) AS n, sum(l_linenumber) AS places FROM e WHERE edge IS NULL OR l_linenumber {op} edge GROUP BY 1"""


@query(_EDGE.format(agg="max", op=">"))
def page_headers_cut(spark, sf_dir):
    kept = segmentation.page_edges(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R", False)
    return kept.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("places"))


@query(_EDGE.format(agg="min", op="<"))
def page_footers_cut(spark, sf_dir):
    kept = segmentation.page_edges(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R", True)
    return kept.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("places"))


@query("SELECT l_orderkey, coalesce(sum(greatest(0, l_discount - 0.05) * greatest(0, l_quantity)), 0) > 0.6 * max(l_tax * 10) AS scanned FROM lineitem GROUP BY 1")
def scanned_pages(spark, sf_dir):
    """Boxes are added as the files hold them, which is the SQL's order on one thread."""
    images = table(spark, sf_dir, "lineitem").withColumns({"w": F.col("l_discount") - 0.05, "area": F.col("l_tax") * 10, "file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    return passes.scanned_pages(images, ["l_orderkey"], "w", "l_quantity", "area", order=["file", "row"])


# --- blocks ----------------------------------------------------------------------


@query(f"""WITH {_BLOCKS}, g AS (SELECT *, coalesce(trim(text) LIKE '%.' AND lead(style) OVER w = 'italic', false) AS gives FROM (SELECT * REPLACE (regexp_replace(text, '[.]$', '-') AS text) FROM b) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
h AS (SELECT *, coalesce(trim(text) LIKE '%-' AND lead(style) OVER w = 'italic', false) AS hands FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
t AS (SELECT *, coalesce(lag(hands) OVER w, false) AND style = 'italic' AS takes FROM h WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
o AS (SELECT conv_id, turn, hands, CASE WHEN takes THEN '-' || trim(text, ' ') ELSE text END AS own FROM t),
z AS (SELECT conv_id, turn, CASE WHEN hands THEN regexp_replace(trim(own, ' '), '-+$', '') ELSE own END AS text FROM o)
SELECT conv_id, turn, length(text) AS n, md5(text) AS digest FROM z""")
def hyphens_forward(spark, sf_dir):
    own = blocks(spark, sf_dir).withColumn("text", F.regexp_replace("text", "[.]\\z", "-"))
    return digest(passes.hyphens_forward(own, "conv_id", "turn", "text", "style"), "conv_id", "turn")


@query("""WITH p AS (SELECT conv_id, turn, role, string_split(text, '. ') AS parts FROM conversations), u AS (SELECT conv_id, turn, role, unnest(parts) AS text, unnest(range(len(parts))) AS part FROM p)
SELECT conv_id, turn, part, CASE WHEN part = 0 THEN role END AS role, length(text) AS n, md5(text) AS digest FROM u""")
def rows_split(spark, sf_dir):
    return digest(segmentation.split_at(table(spark, sf_dir, "conversations"), "text", "[.] ", ["role"]), "conv_id", "turn", "part", "role")


@query("""WITH p AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN list_filter(string_split(replace(text, '. ', chr(1)), chr(1)), lambda x: trim(x) <> '') ELSE [text] END AS parts, text FROM conversations),
q AS (SELECT *, role = 'user' AND len(parts) > 1 AS several FROM p),
u AS (SELECT conv_id, turn, unnest(CASE WHEN several THEN parts ELSE [text] END) AS t, unnest(range(CASE WHEN several THEN len(parts) ELSE 1 END)) AS part, several, len(parts) AS k FROM q)
SELECT conv_id, count(*) AS n_rows, count(*) FILTER (part > 0) AS n_later FROM u GROUP BY 1""")
def welded_notes(spark, sf_dir):
    own = table(spark, sf_dir, "conversations").withColumns({"kind": F.when(F.col("role") == "user", "event").otherwise("speech"), "text": F.when(F.col("role") == "user", F.replace("text", F.lit(". "), F.lit(". — "))).otherwise(F.col("text"))})
    # Every sentence of a user's turn opens with a dash here, so that each is a note of its own.
    own = own.withColumn("text", F.when(F.col("kind") == "event", F.regexp_replace("text", "\\. — ", ". — X")).otherwise(F.col("text")))
    got = passes.welded_notes_split(own, "text", "kind", ["role"])
    return got.groupBy("conv_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("part") > 0).alias("n_later"))


@query("""WITH w AS (SELECT *, coalesce(min(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id), min(CASE WHEN turn = 1 THEN turn END) OVER (PARTITION BY conv_id)) AS begin FROM conversations)
SELECT conv_id, count(*) AS n, min(turn) AS first FROM w WHERE begin IS NULL OR turn >= begin GROUP BY 1""")
def front_matter_cut(spark, sf_dir):
    kept = segmentation.cut_before(table(spark, sf_dir, "conversations"), "conv_id", "turn", [F.col("role") == "assistant", F.col("turn") == 1])
    return kept.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("turn").alias("first"))


@query("""WITH w AS (SELECT *, max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS last FROM conversations)
SELECT conv_id, turn, CASE WHEN turn > last AND length(text) < 300 THEN 'furniture' ELSE role END AS role FROM w""")
def appendix_demoted(spark, sf_dir):
    got = segmentation.demote_after(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "assistant", "role", F.length("text") < 300, "furniture")
    return got.select("conv_id", "turn", "role")


@query("""SELECT user_id, event_id, CASE WHEN event_type IN ('view', 'click') THEN dense_rank() OVER (PARTITION BY user_id, event_type IN ('view', 'click') ORDER BY CASE WHEN event_type IN ('view', 'click') THEN CAST(floor(value) AS BIGINT) END) END AS turn FROM events""")
def turns_renumbered(spark, sf_dir):
    own = table(spark, sf_dir, "events").withColumn("turn", F.when(F.col("event_type").isin("view", "click"), F.floor("value").cast("long")))
    return segmentation.dense_turns(own, "user_id", "turn").select("user_id", "event_id", "turn")


@query("""WITH l AS (SELECT DISTINCT substr(text, 1, 62) AS label FROM conversations WHERE text IS NOT NULL),
t AS (SELECT label, length(label) > 60 AS too_long, regexp_matches(label, '[-–—:(]\\s*$') AS ends_open, len(regexp_extract_all(label, '[(]')) <> len(regexp_extract_all(label, '[)]')) AS unbalanced FROM l)
SELECT * FROM t WHERE too_long OR ends_open OR unbalanced""")
def label_shapes(spark, sf_dir):
    return segmentation.shape_faults(table(spark, sf_dir, "conversations").select(F.substring("text", 1, 62).alias("label")), "label")


@query(f"""WITH {_BLOCKS}, k AS (SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM b),
c AS (SELECT conv_id, turn, CASE WHEN abs(size - 12) > 0.5 THEN 'furniture' WHEN style = 'italic' THEN CASE WHEN regexp_matches(text, '^\\s*[—–−-]') OR starts_with(trim(text), '(')
  OR (regexp_matches(trim(text), '^\\p{{Lu}}') AND (length(trim(text)) > 15 OR trim(text) LIKE '%.') AND (coalesce(regexp_matches(before, '\\s*[—–-]\\s*$'), false)
  OR regexp_matches(lower(text), 'votaci[oó]n|se vota|resulta[n]?\\s+(?:aprobad|rechazad)|afirmativ|negativ|unanimidad|asentimiento|luego de (?:unos )?instantes|cuarto intermedio|se reanuda|aplausos|risas|manifestaciones|interrupci|abucheo|cánticos|murmullos|hablan a la vez|dialogan|interferencias|ingresa|se retira|izamiento|entonaci|himno|arrían'))) THEN 'event' ELSE 'inline' END END AS kind FROM k)
SELECT kind, count(*) AS n FROM c GROUP BY 1""")
def block_kinds(spark, sf_dir):
    got = passes.classified(blocks(spark, sf_dir), "conv_id", "turn", "text", "style", "size", 12.0)
    return got.groupBy("kind").agg(F.count("*").alias("n"))


@query(f"""WITH {_BLOCKS}, s AS (SELECT *, regexp_replace(trim(text), '\\s+', ' ', 'g') AS t, CASE WHEN role = 'user' THEN 'speech' ELSE 'event' END AS kind FROM b),
w AS (SELECT *, last_value(CASE WHEN kind = 'speech' THEN style END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev, lag(kind) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM s),
f AS (SELECT conv_id, turn, unnest(['scrap', 'dangling', 'mid_word']) AS fault, unnest([length(t) <= 3 AND NOT regexp_matches(t, '^(Sí|No|Ya)\\.?$'), regexp_matches(t, '[—–\\-,;]$'), regexp_matches(t, '^[a-záéíóúñ]') AND before <> 'event' AND prev <> style]) AS has FROM w WHERE kind = 'speech' AND t <> '')
SELECT conv_id, turn, fault FROM f WHERE has""")
def turn_shapes(spark, sf_dir):
    own = blocks(spark, sf_dir).withColumn("kind", F.when(F.col("role") == "user", "speech").otherwise("event"))
    return passes.turn_shape_faults(own, "conv_id", "turn", "text", "kind", "style")


@query("""WITH o AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN CAST(floor(value) AS INT) END AS n FROM events WHERE user_id < 40),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM o)
SELECT user_id, event_id, n, k FROM r WHERE n IS NOT NULL""")
def numbered_titles(spark, sf_dir):
    """The titles that the count is kept over; the count itself is tested against plain Python."""
    own = table(spark, sf_dir, "events").where("user_id < 40").withColumn("text", F.concat(F.floor("value").cast("string"), F.lit(" Title")))
    got = passes.chapters(own, "user_id", "event_id", "text", F.col("event_type") == "click")
    k = F.row_number().over(passes.by("user_id", "event_id"))
    return got.withColumn("k", k).where("event_type = 'click'").select("user_id", "event_id", F.floor("value").cast("int").alias("n"), "k")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations) SELECT conv_id, role, turn FROM r WHERE n = 1""")
def first_per_key(spark, sf_dir):
    return placement.first_of_each(table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn").select("conv_id", "role", "turn")


# --- caucuses ---------------------------------------------------------------------------

_READINGS = """r AS (SELECT o_custkey AS person, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS caucus,
  CASE o_orderstatus WHEN 'P' THEN 'deduced' WHEN 'F' THEN 'confirmed' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'unchecked' ELSE 'confirmed' END END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'roll call' ELSE 'page' END AS basis FROM orders WHERE o_custkey % 5 = 0),
y AS (SELECT DISTINCT o_custkey AS person, CAST(o_orderdate AS DATE) + 30 AS day FROM orders WHERE o_custkey % 5 = 0 AND o_orderkey % 4 = 1),
l AS (SELECT * FROM (VALUES ('1-URGENT', DATE '1993-01-01', DATE '1995-06-30'), ('1-URGENT', DATE '1997-01-01', NULL), ('2-HIGH', DATE '1994-03-01', NULL)) AS t(caucus, since, until)),
t AS (SELECT c_custkey AS person, DATE '1992-01-01' AS since, CASE WHEN c_custkey % 2 = 0 THEN DATE '1996-06-01' END AS until FROM customer)"""


def readings(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_custkey % 5 = 0")
    status = F.expr("CASE o_orderstatus WHEN 'P' THEN 'deduced' WHEN 'F' THEN 'confirmed' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'unchecked' ELSE 'confirmed' END END")
    return o.select(F.col("o_custkey").alias("person"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("caucus"), status.alias("status"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'roll call' ELSE 'page' END").alias("basis")), o


def lives(spark):
    return spark.sql("SELECT caucus, CAST(since AS DATE) AS since, CAST(until AS DATE) AS until FROM VALUES ('1-URGENT', '1993-01-01', '1995-06-30'), ('1-URGENT', '1997-01-01', NULL), ('2-HIGH', '1994-03-01', NULL) AS t(caucus, since, until)")


@query(f"""WITH {_READINGS},
j AS (SELECT y.person, y.day, r.date, r.caucus, r.status, r.basis, abs(date_diff('day', r.date, y.day)) AS gap,
  NOT EXISTS (SELECT 1 FROM l WHERE l.caucus = r.caucus) OR EXISTS (SELECT 1 FROM l WHERE l.caucus = r.caucus AND (since IS NULL OR y.day >= since) AND (until IS NULL OR y.day <= until)) AS lived FROM y JOIN r USING (person)),
u AS (SELECT *, status = 'confirmed' AND (basis <> 'roll call' OR lived) AS usable, lower(caucus) AS name, {{'date': date, 'caucus': caucus, 'status': status, 'basis': basis, 'name': lower(caucus), 'gap': gap, 'lived': lived}} AS s FROM j),
n AS (SELECT person, day, s FROM u WHERE status <> 'deduced' QUALIFY row_number() OVER (PARTITION BY person, day ORDER BY gap, date, caucus, status, basis) = 1),
b AS (SELECT person, day, max(s) AS s FROM u WHERE usable AND gap <= 200 AND date <= day GROUP BY ALL), a AS (SELECT person, day, min(s) AS s FROM u WHERE usable AND gap <= 200 AND date >= day GROUP BY ALL),
bb AS (SELECT person, day, max(s) AS s FROM u WHERE usable AND date <= day GROUP BY ALL), aa AS (SELECT person, day, min(s) AS s FROM u WHERE usable AND date >= day GROUP BY ALL),
d AS (SELECT u.person, u.day, u.s FROM u JOIN t ON t.person = u.person AND t.since <= least(u.date, u.day) AND (t.until IS NULL OR greatest(u.date, u.day) <= t.until) WHERE status = 'deduced' AND gap <= 200 QUALIFY row_number() OVER (PARTITION BY u.person, u.day ORDER BY gap, date, caucus) = 1),
e AS (SELECT y.person, y.day, n.s AS n, b.s AS b, a.s AS a, bb.s AS bb, aa.s AS aa, d.s AS d, coalesce(n.s.gap <= 200, false) AS near,
  coalesce(bb.s.name = aa.s.name AND EXISTS (SELECT 1 FROM t WHERE t.person = y.person AND t.since <= bb.s.date AND (t.until IS NULL OR aa.s.date <= t.until)), false) AS held FROM y LEFT JOIN n USING (person, day) LEFT JOIN b USING (person, day) LEFT JOIN a USING (person, day) LEFT JOIN bb USING (person, day) LEFT JOIN aa USING (person, day) LEFT JOIN d USING (person, day)),
f AS (SELECT *, CASE WHEN near THEN n WHEN held THEN CASE WHEN bb.gap <= aa.gap THEN bb ELSE aa END ELSE d END AS x FROM e)
SELECT person, day, x.caucus AS caucus, CASE WHEN near AND n.status = 'confirmed' AND n.basis = 'roll call' AND NOT n.lived THEN 'anachronistic' WHEN near AND n.status = 'confirmed' AND b.name <> a.name THEN 'disputed' WHEN NOT near AND held THEN 'bracketed' ELSE x.status END AS status, x.date AS observed, x.gap AS gap FROM f""")
def caucus_as_of(spark, sf_dir):
    own, o = readings(spark, sf_dir)
    days = o.where("o_orderkey % 4 = 1").select(F.col("o_custkey").alias("person"), F.date_add(F.to_date("o_orderdate"), 30).alias("day"))
    terms = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), F.to_date(F.lit("1992-01-01")).alias("since"), F.when(F.col("c_custkey") % 2 == 0, F.to_date(F.lit("1996-06-01"))).alias("until"))
    return caucus.caucus_on(days, own, lives(spark), terms).select("person", "day", "caucus", "status", "observed", "gap")


@query(f"""WITH {_READINGS}, c AS (SELECT *, NOT EXISTS (SELECT 1 FROM l WHERE l.caucus = r.caucus) OR EXISTS (SELECT 1 FROM l WHERE l.caucus = r.caucus AND (since IS NULL OR r.date >= since) AND (until IS NULL OR r.date <= until)) AS lived FROM r)
SELECT caucus, CASE WHEN NOT lived THEN 'anachronistic' WHEN caucus = '5-LOW' THEN 'unchecked' ELSE 'confirmed' END AS reliability, count(*) AS n FROM c GROUP BY ALL""")
def roll_call_reliability(spark, sf_dir):
    own, _ = readings(spark, sf_dir)
    got = caucus.roll_call_status(own, lives(spark), spark.createDataFrame([("5-LOW",)], "caucus string"))
    return got.groupBy("caucus", "reliability").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT * FROM (VALUES ('view', 'plain', false, 'seen'), ('click', 'plain', false, NULL), ('error', 'failed', true, NULL)) AS t(e, kind, q, a))
SELECT event_type, kind AS session_kind, q AS quorum_failed, CASE WHEN e IS NOT NULL THEN coalesce(a, CASE WHEN event_id % 2 = 0 THEN 'even' END) END AS convened_as, count(*) AS n FROM events LEFT JOIN k ON event_type = e GROUP BY ALL""")
def session_kinds(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("session_id"), F.concat(F.lit(" "), "event_type").alias("session_type"))
    kinds = spark.createDataFrame([("view", "plain", "false", "seen"), ("click ", "plain", "false", ""), ("error", "failed", "true", None)], "session_type string, session_kind string, quorum_failed string, convened_as string")
    evidence = e.where("session_id % 2 = 0").select("session_id", F.lit("even").alias("convened_as"))
    got = caucus.session_facts(e, kinds, evidence)
    return got.groupBy(F.trim("session_type").alias("event_type"), "session_kind", "quorum_failed", "convened_as").agg(F.count("*").alias("n"))


# --- reading pages, placing passages: tested against plain Python ---------------------------


@query()
def html_turns(spark, sf_dir):
    got = transcript.turns(table(spark, sf_dir, "pages"), "page_id", "html")
    return got.groupBy("page_id", "type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"), F.max("turn_id").alias("turns"))


@query("SELECT page_id, len(regexp_extract_all(html, '(?i)<a\\s[^>]*href')) AS n FROM pages")
def page_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.size(html.links(F.col("html"))).cast("long").alias("n"))


@query("""SELECT conv_id, turn, 1 AS occurrence FROM conversations WHERE length(text) < 0""")
def passages_not_placed(spark, sf_dir):
    """Passages that their own conversation does not hold where they are looked for: none."""
    c = table(spark, sf_dir, "conversations")
    rows = F.sort_array(F.collect_list(F.struct("turn", "text")))
    whole = c.groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["text"]), " ").alias("source"))
    got = placement.placed(c, whole, "conv_id", "turn", "text", "source")
    return got.where("place IS NULL").join(c.where(F.trim(F.coalesce("text", F.lit(""))) != "").select("conv_id", "turn"), ["conv_id", "turn"]).select("conv_id", "turn", F.lit(1).alias("occurrence"))


@query("SELECT conv_id, 0.0::DOUBLE AS foreign_share FROM conversations GROUP BY 1")
def source_audit(spark, sf_dir):
    """Every passage of a conversation is in it."""
    c = table(spark, sf_dir, "conversations")
    rows = F.sort_array(F.collect_list(F.struct("turn", "text")))
    whole = c.groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["text"]), " ").alias("source"))
    return placement.audited(c, whole, "conv_id", "text", "source").select("conv_id", F.col("foreign_share").cast("double").alias("foreign_share"))
