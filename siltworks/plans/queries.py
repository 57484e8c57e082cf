"""Queries over the driver's tables, each with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.functions import code, prose
from siltworks.operators import dedup, documents, evaluation, guard, history, pairing, scoring, split, turns
from siltworks.plans import build

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Lexer tokens in SQL: the same pattern, comments dropped, literals as S, words in lower case.
_TOKEN_SQL = code.TOKEN.replace("'", "''")
_NORM_SQL = f"""array_to_string(list_transform(list_filter(regexp_extract_all(text, '{_TOKEN_SQL}'), lambda t: NOT starts_with(t, '--')),
    lambda t: CASE WHEN starts_with(t, '"') OR (starts_with(t, '''') AND length(t) <= 3) THEN 'S' WHEN regexp_matches(t, '^[\\p{{L}}_]') THEN lower(t) ELSE t END), ' ')"""
_REDACT = lambda c: f"regexp_replace({c}, '{prose.SECRET.replace(chr(39), chr(39) * 2)}', '[REDACTED]', 'g')"
_SWAPS_SQL = "text || ' In order to leverage robust tools; we should utilize them ' || (doc_id % 7) || ' times, moreover a plethora'"
for _phrase, _plain in prose.WORD_SWAPS:
    _SWAPS_SQL = "regexp_replace({}, '(?i)\\b{}\\b', '{}', 'g')".format(_SWAPS_SQL, _phrase.replace("'", "''"), _plain)
_BUCKET = "CAST('0x' || substr(md5('42:' || {g}), 1, 8) AS BIGINT) / 4294967296.0"


@query(
    f"""WITH r AS (SELECT doc_id AS seq, 'doc:' || doc_id AS group_id, source, {_REDACT('text')} AS text FROM documents WHERE trim(coalesce(text, '')) <> ''),
        n AS (SELECT *, {_NORM_SQL} AS norm FROM r), p AS (SELECT DISTINCT {_NORM_SQL} AS prompt FROM benchmark),
        clean AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM p WHERE length(prompt) >= 20 AND contains(norm, prompt))),
        first AS (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY text ORDER BY seq) = 1),
        s AS (SELECT *, {_BUCKET.format(g='group_id')} AS h FROM first)
        SELECT CASE WHEN h < 0.05 THEN 'test' WHEN h < 0.1 THEN 'val' ELSE 'train' END AS split, source, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS chars
        FROM s GROUP BY ALL"""
)
def corpus_build(spark, sf_dir):
    return build.summary(build.corpus(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def exact_dedup_first_wins(spark, sf_dir):
    d = read(spark, sf_dir, "documents").withColumn("key", F.sha2("text", 256))
    return d.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("key")


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY regexp_replace(text, '\\s+', ' ', 'g') ORDER BY doc_id) = 1")
def blank_blind_dedup(spark, sf_dir):
    return dedup.first_wins(read(spark, sf_dir, "documents"), [F.sha2(F.regexp_replace("text", r"\s+", " "), 256)], ["doc_id"]).select("doc_id")


@query(
    """WITH d AS (SELECT doc_id AS seq, text AS m, CASE WHEN length(text) % 9 = 0 THEN NULL ELSE length(text) % 40 END AS s, doc_id % 13 = 0 AS e FROM documents),
       f AS (SELECT *, seq = min(seq) OVER (PARTITION BY m) AS first, min(CASE WHEN e THEN seq END) OVER (PARTITION BY m) AS ff, e OR s IS NULL AS free FROM d),
       k AS (SELECT *, first AND (free OR (row_number() OVER (PARTITION BY s, first AND NOT free ORDER BY seq) <= 3)) AS own FROM f),
       h AS (SELECT *, CASE WHEN bool_or(own) OVER (PARTITION BY m) THEN min(seq) OVER (PARTITION BY m) ELSE ff END AS kept_at FROM k)
       SELECT seq, CASE WHEN seq = kept_at THEN 'keep' WHEN seq > kept_at THEN 'exact' ELSE 'capped' END AS verdict FROM h"""
)
def structural_cap_dedup(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.sha2("text", 256).alias("m"), F.when(F.length("text") % 9 != 0, F.length("text") % 40).alias("s"), (F.col("doc_id") % 13 == 0).alias("e"))
    return dedup.ordered_dedup(d, "seq", "m", "s", "e", cap=3).select("seq", "verdict")


@query(f"SELECT doc_id, md5({_REDACT('text')}) AS digest, contains({_REDACT('text')}, '[REDACTED]') AS redacted FROM documents")
def secret_redaction(spark, sf_dir):
    clean = prose.redact_secrets(F.col("text"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(clean).alias("digest"), F.contains(clean, F.lit("[REDACTED]")).alias("redacted"))


@query(f"SELECT doc_id, md5({_SWAPS_SQL}) AS digest FROM documents")
def word_swaps(spark, sf_dir):
    text = F.concat("text", F.lit(" In order to leverage robust tools; we should utilize them "), F.col("doc_id") % 7, F.lit(" times, moreover a plethora"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(prose.swap_words(text)).alias("digest"))


_STYLED = "text || CASE doc_id % 4 WHEN 0 THEN ' - it may fail; really' WHEN 1 THEN ' — leveraged' WHEN 2 THEN ' Seamlessly robust, crucially' ELSE '' END"


@query(
    f"""SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(t, '[—–]') THEN 'em-dash' END, CASE WHEN contains(t, ';') THEN 'semicolon' END, CASE WHEN regexp_matches(t, '(?i)\\b(should|would|may|might)\\b') THEN 'hedge-modal' END,
        {', '.join(f"CASE WHEN regexp_matches(t, '(?i)" + chr(92) + f"b{p}') THEN 'slop:{p}' END" for p in prose.SLOP_PREFIXES)}) AS violations FROM (SELECT doc_id, {_STYLED} AS t FROM documents)"""
)
def style_check(spark, sf_dir):
    t = F.expr(_STYLED)
    return read(spark, sf_dir, "documents").select("doc_id", F.concat_ws(",", prose.style_violations(t)).alias("violations"))


@query(f"SELECT doc_id, md5({_NORM_SQL}) AS digest FROM documents")
def normalized_tokens(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(code.normalized(F.col("text"))).alias("digest"))


_WORDS_SQL = ", ".join(f"'{k}'" for k in code.KEYWORDS)


@query(
    f"""WITH t AS (SELECT doc_id, string_split({_NORM_SQL}, ' ') AS k FROM documents),
        e AS (SELECT doc_id, unnest(k) AS tok, generate_subscripts(k, 1) AS i FROM t),
        f AS (SELECT doc_id, tok, min(i) AS pos FROM e WHERE regexp_matches(tok, '^[\\p{{L}}_]') AND tok NOT IN ({_WORDS_SQL}) GROUP BY ALL),
        n AS (SELECT doc_id, tok, 'N' || row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS name FROM f)
        SELECT e.doc_id, sha256(string_agg(coalesce(n.name, e.tok), ' ' ORDER BY e.i)) AS signature FROM e LEFT JOIN n ON e.doc_id = n.doc_id AND e.tok = n.tok GROUP BY e.doc_id"""
)
def structural_signatures(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", code.signature(code.structural(F.col("text"))).alias("signature"))


@query(
    f"""WITH n AS (SELECT doc_id, {_NORM_SQL} AS norm FROM documents), p AS (SELECT DISTINCT {_NORM_SQL} AS prompt FROM benchmark)
        SELECT doc_id, count(*) AS prompts FROM n JOIN p ON length(prompt) >= 20 AND contains(norm, prompt) GROUP BY doc_id"""
)
def prompt_containment(spark, sf_dir):
    hits = guard.contains_prompt(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark").select(F.col("text").alias("prompt_text")), "doc_id", "text", "prompt_text")
    return hits.groupBy("doc_id").agg(F.count("*").alias("prompts"))


@query(
    f"""WITH n AS (SELECT doc_id, doc_id % 50 AS g, {_NORM_SQL} AS norm FROM documents), p AS (SELECT DISTINCT {_NORM_SQL} AS prompt FROM benchmark),
        bad AS (SELECT DISTINCT g FROM n JOIN p ON length(prompt) >= 20 AND contains(norm, prompt))
        SELECT count(*) AS kept_records, count(DISTINCT g) AS kept_groups FROM n WHERE g NOT IN (FROM bad)"""
)
def contaminated_groups_dropped(spark, sf_dir):
    d = read(spark, sf_dir, "documents").withColumn("g", F.col("doc_id") % 50)
    blocked = guard.contains_prompt(d, read(spark, sf_dir, "benchmark").select(F.col("text").alias("prompt_text")), "doc_id", "text", "prompt_text")
    return guard.drop_groups(d, blocked, "doc_id", "g").agg(F.count("*").alias("kept_records"), F.countDistinct("g").alias("kept_groups"))


@query(f"SELECT source, CASE WHEN h < 0.05 THEN 'test' WHEN h < 0.1 THEN 'val' ELSE 'train' END AS split, count(*) AS n FROM (SELECT source, {_BUCKET.format(g='doc_id')} AS h FROM documents) GROUP BY ALL")
def hashed_split(spark, sf_dir):
    return split.hashed_group_split(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").groupBy("source", "split").agg(F.count("*").alias("n"))


@query()
def seeded_split(spark, sf_dir):
    return split.seeded_group_split(read(spark, sf_dir, "documents").select("doc_id", "source"), "source").groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("source").alias("groups"))


@query("SELECT doc_id FROM documents WHERE md5(text) < '4'")
def content_sample(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(F.md5("text") < "4").select("doc_id")


@query(
    """WITH r AS (SELECT conv_id, count(*) AS n, arg_max(role, turn) AS last_role, arg_max(trim(coalesce(text, '')), turn) AS last_text, string_agg(role, '>' ORDER BY turn) AS roles, sum(length(text)) AS chars FROM conversations GROUP BY conv_id)
       SELECT conv_id, n AS messages, roles, CAST(chars AS BIGINT) AS chars, n >= 2 AND NOT (last_role = 'assistant' AND last_text = '') AS usable FROM r"""
)
def chat_records(spark, sf_dir):
    r = turns.to_records(read(spark, sf_dir, "conversations"))
    return r.select("conv_id", F.size("messages").cast("long").alias("messages"), F.array_join("messages.role", ">").alias("roles"), F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"])).alias("chars"), turns.usable().alias("usable"))


@query(
    """WITH c AS (SELECT DISTINCT conv_id FROM conversations), k AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS n, greatest(count(*) OVER () // 4, 1) AS m FROM c)
       SELECT k.conv_id, count(*) + max(CASE WHEN n <= m THEN 1 ELSE 0 END) AS messages FROM conversations JOIN k USING (conv_id) GROUP BY k.conv_id"""
)
def leading_quarter_injection(spark, sf_dir):
    r = turns.to_records(read(spark, sf_dir, "conversations"))
    extra = turns.message("system", F.lit("Write plain prose."))
    return split.inject_first_share(r, "conv_id", "messages", extra).select("conv_id", F.size("messages").cast("long").alias("messages"))


@query("SELECT role, count(*) AS n, count(*) FILTER (length(text) > 400) AS long FROM conversations GROUP BY role")
def kind_tally(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(F.length("text") > 400).alias("long"))


_ENTRIES = """SELECT CASE l.doc_id % 2 WHEN 0 THEN 'base' ELSE 'tuned' END AS model, d.source AS dataset, k.eval, l.quality = 1 AS compiled, l.toxic = 0 AS passed_tests,
    CASE l.doc_id % 5 WHEN 0 THEN 'proved' WHEN 1 THEN 'unproved' WHEN 2 THEN 'proved_incorrectly' WHEN 3 THEN 'timeout' END AS result
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id CROSS JOIN (SELECT 'build' AS eval UNION ALL SELECT 'test' UNION ALL SELECT 'prove') k"""


def _entries(spark, sf_dir):
    kinds = F.explode(F.array(F.lit("build"), F.lit("test"), F.lit("prove"))).alias("eval")
    both = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    m = F.col("doc_id") % 5
    result = F.when(m == 0, "proved").when(m == 1, "unproved").when(m == 2, "proved_incorrectly").when(m == 3, "timeout")
    return both.select(F.when(F.col("doc_id") % 2 == 0, "base").otherwise("tuned").alias("model"), F.col("source").alias("dataset"), kinds, (F.col("quality") == 1).alias("compiled"), (F.col("toxic") == 0).alias("passed_tests"), result.alias("result"))


@query(
    f"""WITH e AS ({_ENTRIES}) SELECT count(*) FILTER (eval = 'build' AND compiled) AS build_compiled, count(*) FILTER (eval = 'build' AND NOT compiled) AS build_failed, count(*) FILTER (eval = 'build') AS build_total,
        count(*) FILTER (eval = 'test' AND compiled AND passed_tests) AS test_passed, count(*) FILTER (eval = 'test' AND NOT (compiled AND passed_tests)) AS test_failed, count(*) FILTER (eval = 'test') AS test_total,
        count(*) FILTER (eval = 'prove' AND result = 'proved') AS prove_proved, count(*) FILTER (eval = 'prove' AND result IN ('unproved', 'proved_incorrectly', 'subprogram_not_found')) AS prove_unproved,
        count(*) FILTER (eval = 'prove' AND (result IS NULL OR result NOT IN ('proved', 'unproved', 'proved_incorrectly', 'subprogram_not_found'))) AS prove_error, count(*) FILTER (eval = 'prove') AS prove_total FROM e"""
)
def evaluation_tally(spark, sf_dir):
    return scoring.tally(_entries(spark, sf_dir))


@query(
    f"""WITH e AS ({_ENTRIES}), s AS (SELECT model, dataset, CAST(grouping(dataset) AS INT) AS whole, count(*) FILTER (eval = 'build') AS samples, count(*) FILTER (eval = 'build' AND compiled) AS build,
        count(*) FILTER (eval = 'test' AND passed_tests) AS test, count(*) FILTER (eval = 'prove' AND result = 'proved') AS proved, count(*) FILTER (eval = 'prove' AND result IN ('unproved', 'proved_incorrectly', 'subprogram_not_found')) AS unproved
        FROM e GROUP BY GROUPING SETS ((model), (model, dataset)))
        SELECT *, CASE WHEN samples > 0 THEN round_even(100.0::DOUBLE * build / samples, 1) END AS build_pct, CASE WHEN samples > 0 THEN round_even(100.0::DOUBLE * test / samples, 1) END AS test_pct FROM s"""
)
def model_report(spark, sf_dir):
    return scoring.report(_entries(spark, sf_dir))


@query("SELECT d.source, count(*) AS docs, count(l.doc_id) AS labelled, round_even(100.0::DOUBLE * sum(l.quality) / count(l.doc_id), 1) AS good_pct FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source")
def label_coverage(spark, sf_dir):
    j = read(spark, sf_dir, "documents").select("doc_id", "source").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return j.groupBy("source").agg(F.count("*").alias("docs"), F.count("quality").alias("labelled"), code.percent(F.sum("quality"), F.count("quality")).alias("good_pct"))


@query(
    """SELECT user_id, event_id, previous, coalesce(previous > 0 AND (value - previous) / previous > 0.25, false) AS jumped
       FROM (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events)"""
)
def loss_jumps(spark, sf_dir):
    return history.jumps(read(spark, sf_dir, "events"), "user_id", "ts", "value").select("user_id", "event_id", "previous", "jumped")


@query(
    """WITH w AS (SELECT user_id, event_id, row_number() OVER o AS n, min(value) OVER (o ROWS UNBOUNDED PRECEDING) AS best, min(value) OVER (o ROWS 2 PRECEDING) AS recent FROM events WINDOW o AS (PARTITION BY user_id ORDER BY event_id))
       SELECT user_id, min(event_id) AS stop_step FROM w WHERE n > 3 AND recent > best + 1e-3 GROUP BY user_id"""
)
def early_stop(spark, sf_dir):
    return history.early_stop(read(spark, sf_dir, "events"), "user_id", "event_id", "value")


@query(
    """WITH c AS (SELECT user_id, event_id, ts FROM events WHERE event_type = (SELECT min(event_type) FROM events)), o AS (SELECT user_id, ts, value FROM events WHERE event_type <> (SELECT min(event_type) FROM events))
       SELECT c.user_id, c.event_id, o.value AS value_as_of FROM c ASOF LEFT JOIN o ON c.user_id = o.user_id AND c.ts >= o.ts"""
)
def as_of_join(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    least = e.agg(F.min("event_type").alias("least"))
    e = e.join(F.broadcast(least))
    left, right = e.where("event_type = least").select("user_id", "event_id", "ts"), e.where("event_type <> least").select("user_id", "ts", "value")
    return history.as_of(left, right, "user_id", "ts", "ts", "value").select("user_id", "event_id", "value_as_of")


_TREND = """WITH ev AS (SELECT user_id AS run, event_id AS step, value AS loss FROM events WHERE event_id % 2 = 0), tr AS (SELECT user_id AS run, event_id AS step, value AS loss FROM events WHERE event_id % 2 = 1),
    x AS (SELECT run, count(*) AS points, arg_min(loss, step) AS first, arg_max(loss, step) AS last, min(loss) AS best FROM ev GROUP BY run),
    b AS (SELECT ev.run, min(step) AS best_step FROM ev JOIN x ON ev.run = x.run AND loss = best GROUP BY ev.run),
    i AS (SELECT ev.run, count(*) AS best_index FROM ev JOIN b ON ev.run = b.run AND step < best_step GROUP BY ev.run),
    j AS (SELECT run, bool_or(prev > 0 AND (loss - prev) / prev > 0.25) AS jumped FROM (SELECT run, loss, lag(loss) OVER (PARTITION BY run ORDER BY step) AS prev FROM ev) GROUP BY run),
    t AS (SELECT tr.run, arg_max(loss, step) AS train_last, arg_max(loss, step) FILTER (step <= best_step) AS train_at_best FROM tr JOIN b ON tr.run = b.run GROUP BY tr.run),
    y AS (SELECT x.*, b.best_step, coalesce(i.best_index, 0) AS best_index, coalesce(j.jumped, false) AS jumped, t.train_last, t.train_at_best, CASE WHEN best > 0 THEN (last - best) / best ELSE 0 END AS rose FROM x JOIN b USING (run) LEFT JOIN i USING (run) LEFT JOIN j USING (run) LEFT JOIN t USING (run))
    SELECT run, CASE WHEN points < 2 THEN 'sparse' WHEN best_index < points - 1 AND rose > 0.05 AND coalesce(train_last < train_at_best, false) THEN 'overfit' WHEN jumped THEN 'unstable'
        WHEN (best_index < points - 1 AND rose > 0.05) OR (best_index <= points // 2 AND best_index < points - 1) THEN 'plateau' ELSE 'healthy' END AS verdict FROM y"""


@query(_TREND)
def trend_verdict(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    return history.trend(e.where("step % 2 = 0"), e.where("step % 2 = 1"))


@query("SELECT user_id, count(*) AS points, arg_min(value, event_id) AS first, arg_max(value, event_id) AS last, min(value) AS best, arg_min(event_id, (value, event_id)) AS best_step FROM events GROUP BY user_id")
def history_extremes(spark, sf_dir):
    return history.extremes(read(spark, sf_dir, "events"), "user_id", "event_id", "value")


@query(
    """SELECT source, doc_id, used FROM (SELECT source, doc_id, CAST(coalesce(sum(least(n_chars, 12000)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS used FROM documents) WHERE used < 16000"""
)
def budgeted_prefix(spark, sf_dir):
    return history.budget_prefix(read(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 12_000, 16_000).select("source", "doc_id", F.col("used").cast("long").alias("used"))


@query("SELECT event_type, round(loss, 6) AS loss, round_even(exp(loss), 3) AS perplexity FROM (SELECT event_type, sum(value * user_id) / sum(user_id) / 100 AS loss FROM events GROUP BY event_type)")
def weighted_loss(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("total", F.col("value") * F.col("user_id") / 100)
    return history.weighted_mean(e, "event_type", "total", "user_id").withColumn("loss", F.round("loss", 6))


@query()
def shortest_first_batches(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("source").alias("grp"), F.col("doc_id").alias("idx"), F.col("n_chars").alias("length"))
    return history.plan_batches(d, 256, 16, 40_000)


@query("SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS links FROM pages")
def page_parts(spark, sf_dir):
    return documents.page_parts(read(spark, sf_dir, "pages")).select("page_id", "title", F.size("links").cast("long").alias("links"))


_SLUG_SQL = "replace(trim(regexp_replace(regexp_replace(lower(trim(title)), '^#{1,6}\\s+', ''), '[^\\w\\- ]', '', 'g')), ' ', '-')"


@query(
    f"""WITH h AS (SELECT page_id % 25 AS path, page_id AS seq, 'Part ' || (page_id % 3) || ': a_b, (c)!' AS title FROM pages), s AS (SELECT *, {_SLUG_SQL} AS slug FROM h)
        SELECT path, seq, slug || CASE WHEN row_number() OVER w = 1 THEN '' ELSE '-' || (row_number() OVER w - 1) END AS anchor FROM s WINDOW w AS (PARTITION BY path, slug ORDER BY seq)"""
)
def heading_anchors(spark, sf_dir):
    h = read(spark, sf_dir, "pages").select((F.col("page_id") % 25).alias("path"), F.col("page_id").alias("seq"), F.concat(F.lit("Part "), F.col("page_id") % 3, F.lit(": a_b, (c)!")).alias("title"))
    return documents.anchors(h).select("path", "seq", "anchor")


@query(
    """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target FROM pages), known AS (SELECT DISTINCT '/' || regexp_extract(text, '^\\w+') AS f FROM benchmark)
       SELECT page_id, count(*) AS broken FROM l WHERE NOT regexp_matches(target, '^(#|http://|https://|mailto:|ftp://)') AND trim(target) <> '' AND (contains(target, ' ') OR split_part(target, '#', 1) NOT IN (FROM known)) GROUP BY page_id"""
)
def broken_links(spark, sf_dir):
    parts = documents.page_parts(read(spark, sf_dir, "pages"))
    links = parts.select(F.col("page_id").alias("path"), F.explode("links").alias("target"))
    files = read(spark, sf_dir, "benchmark").select(F.concat(F.lit("/"), F.regexp_extract("text", r"^\w+", 0)).alias("path")).distinct()
    none = files.where("false").select("path", F.lit("").alias("anchor"))
    return documents.link_errors(links, files, none).groupBy(F.col("path").alias("page_id")).agg(F.count("*").alias("broken"))


_BLEU_SQL = """WITH p AS (SELECT a.doc_id AS id, regexp_extract_all(a.text, '{t}') AS r, regexp_extract_all(b.text, '{t}') AS h FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
    e AS (SELECT id, side, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM (SELECT id, 'r' AS side, r AS w FROM p UNION ALL SELECT id, 'h', h FROM p)),
    k AS (SELECT id, side, t, lead(t) OVER w AS t2, lead(t, 2) OVER w AS t3, lead(t, 3) OVER w AS t4 FROM e WINDOW w AS (PARTITION BY id, side ORDER BY i)),
    g AS (SELECT id, side, n, CASE n WHEN 1 THEN t WHEN 2 THEN t || chr(1) || t2 WHEN 3 THEN t || chr(1) || t2 || chr(1) || t3 ELSE t || chr(1) || t2 || chr(1) || t3 || chr(1) || t4 END AS g FROM k CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n)),
    c AS (SELECT id, n, g, count(*) FILTER (side = 'r') AS cr, count(*) FILTER (side = 'h') AS ch FROM g WHERE g IS NOT NULL GROUP BY ALL),
    o AS (SELECT id, n, sum(least(cr, ch)) AS clipped, sum(ch) AS total FROM c GROUP BY ALL),
    l AS (SELECT id, sum(ln((clipped + 1) / (total + 1))) AS logs, count(*) AS k FROM o WHERE total > 0 GROUP BY id)
    SELECT p.id, round(CASE WHEN len(r) = 0 OR len(h) = 0 THEN 0.0 ELSE (CASE WHEN len(h) > len(r) THEN 1.0 ELSE exp(1 - len(r) / greatest(len(h), 1)) END) * exp((logs + (4 - k) * ln(1e-9)) / 4) END, 9) AS bleu FROM p LEFT JOIN l ON p.id = l.id"""


@query(_BLEU_SQL.format(t=code.SCORE_TOKEN.replace("'", "''")))
def bleu_scores(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = d.select(F.col("doc_id").alias("id"), F.col("text").alias("reference")).join(d.select((F.col("doc_id") - 1).alias("id"), F.col("text").alias("hypothesis")), "id")
    return scoring.bleu(pairs).select("id", F.round("bleu", 9).alias("bleu"))


# Whole documents with a fragment of code chosen by id in their middle, as the tables hold none.
_FRAGMENTS = """SELECT * FROM (VALUES
    (1, 'package P is procedure Q; end P;'), (2, 'procedure Q with Pre => X > 0, Post => Y;'), (3, 'package body P is pragma SPARK_Mode (On); Ghost'),
    (4, '-- Pre => in a comment' || chr(10) || 'x := 1'), (5, 'type T is tagged null record; aliased'), (6, 'A := [for I in 1 .. 3 => 0]''Reduce (X, 0)'), (7, 'text "Post => here" only'),
    (8, 'type I is interface; use type X;'), (9, 'pragma Assert (X); overriding procedure Z is null;'), (10, 'function F (X : Integer) return Integer is (X + 1);'), (11, ''), (12, 'task body T'), (13, 'gnatprove Ghost')) AS t(f, fragment)"""
_HALF = "length(coalesce(text, '')) // 2"
_CODE_ROWS = f"SELECT doc_id AS id, substr(coalesce(text, ''), 1, {_HALF}) || chr(10) || fragment || chr(10) || substr(coalesce(text, ''), 1 + {_HALF}) AS code FROM documents JOIN ({_FRAGMENTS}) ON f = 1 + doc_id % 13"


def _code_rows(spark, sf_dir):
    t, half = F.coalesce("text", F.lit("")), F.floor(F.length(F.coalesce("text", F.lit(""))) / 2).cast("int")
    d = read(spark, sf_dir, "documents").select((1 + F.col("doc_id") % 13).alias("f"), F.col("doc_id").alias("id"), F.substring(t, F.lit(1), half).alias("head"), F.substring(t, half + 1, F.length(t)).alias("tail"))
    return d.join(F.broadcast(spark.sql(_FRAGMENTS)), "f").select("id", F.concat_ws("\n", "head", "fragment", "tail").alias("code"))  # 13 fragments


_TIERS_SQL = "CASE " + " ".join("WHEN " + " + ".join(f"(CASE WHEN regexp_matches(c, '{p.replace(chr(39), chr(39) * 2)}') THEN {w} ELSE 0 END)" for p, w in features) + f" >= 2 THEN '{name}'" for name, features in code.STANDARDS) + " ELSE 'Unknown' END"


@query(f"""SELECT id, {_TIERS_SQL} AS standard FROM (SELECT id, regexp_replace(regexp_replace(code, '--[^\\n]*', ' ', 'g'), '"(?:[^"]|"")*"', '""', 'g') AS c FROM ({_CODE_ROWS}))""")
def code_standard(spark, sf_dir):
    return _code_rows(spark, sf_dir).select("id", code.standard(F.col("code")).alias("standard"))


_MARKERS_SQL = "CASE standard " + " ".join(f"WHEN '{n}' THEN (" + " + ".join(f"(CASE WHEN contains(code, '{m}') THEN 1 ELSE 0 END)" for m in ms) + f") / {len(ms)}.0" for n, ms in code.MARKERS.items()) + " ELSE 0.0 END"


@query(f"SELECT id, round(CAST({_MARKERS_SQL} AS DOUBLE), 9) AS compliance FROM (SELECT id, code, CASE id % 3 WHEN 0 THEN 'SPARK 2014' WHEN 1 THEN 'Ada 83' ELSE 'Ada 2012' END AS standard FROM ({_CODE_ROWS}))")
def marker_compliance(spark, sf_dir):
    s = F.when(F.col("id") % 3 == 0, "SPARK 2014").when(F.col("id") % 3 == 1, "Ada 83").otherwise("Ada 2012")
    return _code_rows(spark, sf_dir).select("id", F.round(code.compliance(F.col("code"), s), 9).alias("compliance"))


_FILE_ROWS = "SELECT * FROM (VALUES ('a/p.ads'), ('a/p.adb'), ('a/q.ADS'), ('b/p.adb'), ('b/r.ads'), ('b/r.adb'), ('c/x.gpr'), ('c/P.ads'), ('c/p.adb')) AS t(path)"


@query(
    f"""WITH f AS (SELECT path, split_part(path, '/', 1) AS dir, split_part(split_part(path, '/', 2), '.', 1) AS stem, lower(split_part(path, '.', 2)) AS ext FROM ({_FILE_ROWS})),
        s AS (SELECT dir, stem, path AS spec FROM f WHERE ext = 'ads'), b AS (SELECT dir, stem, path AS impl FROM f WHERE ext = 'adb') SELECT dir, stem, spec, impl FROM s FULL JOIN b USING (dir, stem)"""
)
def file_pairs(spark, sf_dir):
    return pairing.pair_files(spark.sql(_FILE_ROWS))


_DECLS = "SELECT * FROM (VALUES (1, 'Pk', 'function', 'F', 'd1'), (2, 'Pk', 'function', 'f', 'd2'), (3, 'Pk', 'procedure', 'F', 'd3'), (4, 'Other', 'function', 'F', 'd4')) AS t(seq, package, kind, name, text)"
_BODIES = "SELECT * FROM (VALUES (1, 'PK', 'function', 'F', 'b1'), (2, 'pk', 'function', 'F', 'b2'), (3, 'pk', 'procedure', 'g', 'b3')) AS t(seq, package, kind, name, text)"


@query(
    f"""WITH d AS ({_DECLS}), b AS (SELECT * FROM ({_BODIES}) QUALIFY row_number() OVER (PARTITION BY lower(package), lower(kind), lower(name) ORDER BY seq) = 1)
        SELECT d.seq, d.text, b.text AS body_text FROM d LEFT JOIN b ON lower(d.package) = lower(b.package) AND lower(d.kind) = lower(b.kind) AND lower(d.name) = lower(b.name)"""
)
def declaration_bodies(spark, sf_dir):
    return pairing.declaration_bodies(spark.sql(_DECLS), spark.sql(_BODIES)).select("seq", "text", "body_text")


_LABS = "SELECT * FROM (VALUES ('r', 'l1', 'prompt', 'm.adb', 'a'), ('r', 'l1', 'answer', 'm.adb', 'b'), ('r', 'l2', 'prompt', 'm.adb', 'same '), ('r', 'l2', 'answer', 'm.adb', 'same'), ('r', 'l3', 'prompt', 'x.adb', 'only')) AS t(root, lab, side, rel, text)"


@query(f"SELECT p.lab, p.text AS prompt, a.text AS answer FROM ({_LABS}) p JOIN ({_LABS}) a USING (root, lab, rel) WHERE p.side = 'prompt' AND a.side = 'answer' AND trim(p.text) <> trim(a.text)")
def lab_twins(spark, sf_dir):
    return pairing.lab_twins(spark.sql(_LABS)).select("lab", "prompt", "answer")


_CACHE = "SELECT * FROM (VALUES ('a', true, 'c1'), ('b', true, 'c2'), ('c', true, CAST(NULL AS VARCHAR(9))), ('d', false, CAST(NULL AS VARCHAR(9))), ('e', true, 'c5')) AS t(source, present, commit)"
_HEADS = "SELECT * FROM (VALUES ('a', 'c1'), ('b', 'c9'), ('c', 'c3'), ('d', 'c4')) AS t(source, head)"


@query(f"SELECT source, CASE WHEN NOT present THEN 'absent' WHEN commit IS NULL THEN 'untracked' WHEN head IS NULL THEN 'unknown' WHEN commit = head THEN 'current' ELSE 'moved' END AS status FROM ({_CACHE}) LEFT JOIN ({_HEADS}) USING (source)")
def cache_status(spark, sf_dir):
    return pairing.cache_status(spark.sql(_CACHE), spark.sql(_HEADS))


@query("SELECT l_orderkey AS unit, bool_and(l_returnflag <> 'R') AS proved FROM lineitem GROUP BY l_orderkey")
def all_of(spark, sf_dir):
    return scoring.all_proved(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), (F.col("l_returnflag") != "R").alias("proved")))


@query(
    """SELECT v FROM (SELECT DISTINCT (l_linenumber || '.' || (l_suppkey % 12) || '.' || (l_partkey % 12)) AS v FROM lineitem) ORDER BY CAST(split_part(v, '.', 1) AS INT) DESC, CAST(split_part(v, '.', 2) AS INT) DESC, CAST(split_part(v, '.', 3) AS INT) DESC LIMIT 3"""
)
def latest_versions(spark, sf_dir):
    v = read(spark, sf_dir, "lineitem").select(F.concat_ws(".", "l_linenumber", F.col("l_suppkey") % 12, F.col("l_partkey") % 12).alias("v")).distinct()
    return v.orderBy(F.transform(F.split("v", r"\."), lambda x: x.cast("int")).desc()).limit(3)


@query("SELECT word, n FROM (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark) GROUP BY word) ORDER BY n DESC, word LIMIT 8")
def most_common(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(8)


@query("SELECT l_suppkey AS k, CAST(sum(least(a, b)) AS BIGINT) AS common FROM (SELECT l_suppkey, l_partkey % 100 AS p, count(*) FILTER (l_returnflag = 'N') AS a, count(*) FILTER (l_returnflag <> 'N') AS b FROM lineitem GROUP BY ALL) GROUP BY l_suppkey")
def multiset_intersection(spark, sf_dir):
    c = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", (F.col("l_partkey") % 100).alias("p")).agg(F.count_if(F.col("l_returnflag") == "N").alias("a"), F.count_if(F.col("l_returnflag") != "N").alias("b"))
    return c.groupBy(F.col("l_suppkey").alias("k")).agg(F.sum(F.least("a", "b")).alias("common"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 40")
def probe_exclusion(spark, sf_dir):
    return split.first_not_excluded(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels"), "doc_id", "doc_id", 40)


_REPLIES = """SELECT * FROM (VALUES
    (1, 'File: src/a.ads' || chr(10) || '```ada' || chr(10) || 'package A is end A;' || chr(10) || '```'), (2, 'Sure:' || chr(10) || '```ada' || chr(10) || 'package body B is' || chr(10) || 'end B;' || chr(10) || '```'),
    (3, 'raw text'), (4, 'File: /etc/x.ads' || chr(10) || '```' || chr(10) || 'y' || chr(10) || '```'), (5, 'File: ../x.adb' || chr(10) || chr(10) || '```' || chr(10) || 'z' || chr(10) || '```'), (6, '```' || chr(10) || 'plain' || chr(10) || '```')) AS t(id, reply)"""


@query(
    f"""SELECT id, CASE WHEN regexp_matches(reply, '(?s)File:\\s*[^/.\\s]\\S*\\.(ads|adb|gpr|adc)\\s*\\n+```[^\\n]*\\n.*?```') THEN 'file_blocks' WHEN contains(reply, '```') THEN 'fenced_block' ELSE 'raw_text' END AS shape,
        trim(coalesce(nullif(regexp_extract(reply, '(?s)```ada\\s*\\n(.*?)```', 1), ''), nullif(regexp_extract(reply, '(?s)```\\s*\\n(.*?)```', 1), ''), reply), chr(10)) AS code FROM ({_REPLIES})"""
)
def reply_shapes(spark, sf_dir):
    return spark.sql(_REPLIES).select("id", code.reply_format(F.col("reply")).alias("shape"), code.reply_code(F.col("reply")).alias("code"))


@query("SELECT o_orderkey AS id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm' || lpad((s % 60)::VARCHAR, 2, '0') || 's' ELSE (s // 3600) || 'h' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || 'm' END AS took FROM (SELECT o_orderkey, o_orderkey % 9000 AS s FROM orders)")
def durations(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), code.duration(F.col("o_orderkey") % 9000).alias("took"))


@query("SELECT conv_id, coalesce(string_agg(turn || ':' || text, ' | ' ORDER BY turn, role, text), '') AS joined FROM conversations GROUP BY conv_id")
def ordered_concat(spark, sf_dir):
    return turns.joined(read(spark, sf_dir, "conversations"))


@query("SELECT id, md5(text) AS digest FROM (SELECT doc_id AS id, CAST(from_base64(to_base64(encode(text))) AS BLOB) AS b, text FROM documents)")
def base64_round_trip(spark, sf_dir):
    m = F.create_map(F.lit("a.ads"), F.base64(F.encode("text", "UTF-8")))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.md5(scoring.decode_files(m)["a.ads"]).alias("digest"))


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) % 5 AS k5, count(*) AS n FROM events GROUP BY ALL")
def json_fields(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("event_type", (F.get_json_object("props", "$.k").cast("int") % 5).alias("k5")).agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM documents WHERE length(text) BETWEEN 120 AND 6000 AND contains(text, chr(10))")
def usable_length(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(F.length("text").between(120, 6000) & F.contains("text", F.lit("\n"))).select("doc_id")


@query("SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 3")
def top_per_group(spark, sf_dir):
    w = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return read(spark, sf_dir, "documents").withColumn("n", F.row_number().over(w)).where("n <= 3").select("source", "doc_id")


# Samples of a benchmark: a document is a generated file of dataset spark_<source> or <source>; a tenth have none.
_SAMPLES = "SELECT doc_id AS seq, CASE WHEN doc_id % 2 = 0 THEN 'spark_' ELSE '' END || source AS dataset, lang || '_' || (doc_id // 3) AS name, CASE WHEN doc_id % 10 <> 3 THEN text END AS text FROM documents"


def _samples(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    name = F.concat_ws("_", "lang", F.floor(F.col("doc_id") / 3).cast("string"))
    files = F.when((F.col("doc_id") % 10 != 3) & F.col("text").isNotNull(), F.create_map(F.lit("src/a.ads"), F.col("text"))).otherwise(F.create_map().cast("map<string,string>"))
    return d.select(F.col("doc_id").alias("seq"), F.concat(F.when(F.col("doc_id") % 2 == 0, "spark_").otherwise(""), F.col("source")).alias("dataset"), name.alias("name"), files.alias("files"))


@query(f"SELECT dataset, name, max(seq) AS seq, md5(arg_max(text, seq)) AS digest FROM ({_SAMPLES}) WHERE text IS NOT NULL GROUP BY dataset, name")
def reference_index(spark, sf_dir):
    return evaluation.reference_index(_samples(spark, sf_dir)).select("dataset", "name", "seq", F.md5(F.col("files")["src/a.ads"]).alias("digest"))


@query(f"SELECT dataset, count(*) AS samples, count(*) FILTER (text IS NULL) AS hollow, count(*) FILTER (text IS NULL) = 0 AS ok FROM ({_SAMPLES}) GROUP BY dataset")
def packed_samples_verified(spark, sf_dir):
    return evaluation.verified(_samples(spark, sf_dir))


@query(f"SELECT seq, dataset FROM ({_SAMPLES}) WHERE regexp_replace(dataset, '^spark_', '') IN ('src0', 'src1')")
def wanted_datasets(spark, sf_dir):
    return evaluation.wanted_datasets(_samples(spark, sf_dir), ["spark_src0", "src1"]).select("seq", "dataset")


_KIND = "CASE event_id % 4 WHEN 0 THEN 'build' WHEN 1 THEN 'test' WHEN 2 THEN 'prove' ELSE 'other' END"


def _kinds(spark, sf_dir):
    k = F.col("event_id") % 4
    return read(spark, sf_dir, "events").select("event_id", "event_type", "value", F.when(k == 0, "build").when(k == 1, "test").when(k == 2, "prove").otherwise("other").alias("eval"))


@query(f"SELECT event_id, {_KIND} AS eval FROM events WHERE {_KIND} IN ('build', 'prove')")
def wanted_kinds(spark, sf_dir):
    return evaluation.wanted_kinds(_kinds(spark, sf_dir), ["prove", "other", "build"]).select("event_id", "eval")


@query("""WITH f AS (SELECT conv_id, CASE turn WHEN 0 THEN 'other.json' WHEN 1 THEN 'prompt.md' WHEN 2 THEN 'comments.md' ELSE 'base/f' || turn || '.ads' END AS path, any_value(text) AS text FROM conversations WHERE text IS NOT NULL GROUP BY ALL)
    SELECT conv_id AS sample, md5(max(text) FILTER (path = 'prompt.md')) AS prompt, md5(max(text) FILTER (path = 'comments.md')) AS comments, count(*) FILTER (starts_with(path, 'base/')) AS base_files
    FROM f GROUP BY conv_id HAVING count(*) FILTER (path = 'other.json') > 0 AND count(*) FILTER (path = 'prompt.md') > 0""")
def expanded_samples(spark, sf_dir):
    t = F.col("turn")
    path = F.when(t == 0, "other.json").when(t == 1, "prompt.md").when(t == 2, "comments.md").otherwise(F.concat(F.lit("base/f"), t.cast("string"), F.lit(".ads")))
    f = read(spark, sf_dir, "conversations").where("text IS NOT NULL").select(F.col("conv_id").alias("sample"), path.alias("path"), "text")
    return evaluation.expanded_samples(f).select("sample", F.md5("prompt").alias("prompt"), F.md5("comments").alias("comments"), F.size("base").cast("long").alias("base_files"))


_SCORED = "SELECT source AS model, lang AS standard, round(CAST(n_chars % 101 AS DOUBLE) / 100, 9) AS bleu, CAST(doc_id % 3 = 0 AS INT) AS exact, CAST(doc_id % 2 = 0 AS INT) AS file_set, CAST(n_chars % 5 AS DOUBLE) / 4 AS compliance FROM documents"


@query(f"""SELECT m.model, scored, round(bleu, 6) AS bleu, round(exact, 6) AS exact, round(file_set, 6) AS file_set, round(compliance, 6) AS compliance, standards
    FROM (SELECT model, count(*) AS scored, avg(bleu) AS bleu, avg(exact) AS exact, avg(file_set) AS file_set, avg(compliance) AS compliance FROM ({_SCORED}) GROUP BY model) m
    JOIN (SELECT model, string_agg(standard || '=' || n, ',' ORDER BY standard) AS standards FROM (SELECT model, standard, count(*) AS n FROM ({_SCORED}) GROUP BY ALL) GROUP BY model) s ON m.model = s.model""")
def model_score(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    scored = d.select(F.col("source").alias("model"), F.col("lang").alias("standard"), F.round((F.col("n_chars") % 101).cast("double") / 100, 9).alias("bleu"), (F.col("doc_id") % 3 == 0).cast("int").alias("exact"), (F.col("doc_id") % 2 == 0).cast("int").alias("file_set"), ((F.col("n_chars") % 5).cast("double") / 4).alias("compliance"))
    out = evaluation.model_score(scored, "model")
    text = F.array_join(F.transform(F.map_entries("standards"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.select("model", "scored", *(F.round(c, 6).alias(c) for c in ("bleu", "exact", "file_set", "compliance")), text.alias("standards"))


@query("""WITH j AS (SELECT CASE quality WHEN 1 THEN 'file_blocks' WHEN 0 THEN 'raw_text' END AS f, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL)
    SELECT (SELECT count(*) FROM j) AS known, (SELECT string_agg(f || '=' || n, ',' ORDER BY f) FROM (SELECT f, count(*) AS n FROM j GROUP BY f)) AS by_format, (SELECT count(*) FROM j WHERE toxic = 0) AS unchanged""")
def reply_summary(spark, sf_dir):
    scored = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"))
    meta = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("name"), F.when(F.col("quality") == 1, "file_blocks").when(F.col("quality") == 0, "raw_text").alias("reply_format"), F.col("toxic").alias("changed_files"))
    text = F.array_join(F.transform(F.map_entries("by_format"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return evaluation.reply_summary(scored, meta).select("known", text.alias("by_format"), "unchanged")


@query("SELECT strftime(l_shipdate, '%Y') AS family, count(*) FILTER (l_returnflag = 'A') AS passed, count(*) FILTER (l_returnflag = 'R') AS failed, count(*) FILTER (l_returnflag = 'N') AS skipped FROM lineitem GROUP BY 1")
def family_tally(spark, sf_dir):
    outcome = F.when(F.col("l_returnflag") == "A", "pass").when(F.col("l_returnflag") == "R", "fail").otherwise("skip")
    return evaluation.family_tally(read(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy").alias("family"), outcome.alias("outcome")))


@query("SELECT p_type AS \"check\", CAST(sum(p_size) AS BIGINT) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 8")
def check_histogram(spark, sf_dir):
    return evaluation.check_histogram(read(spark, sf_dir, "part").select(F.create_map("p_type", F.col("p_size").cast("long")).alias("unproved_checks")))


# Units: documents as bodies of packages, whose context clause depends on the id.
_WITH = "CASE doc_id % 3 WHEN 0 THEN 'with Ada.Text_IO, System;' WHEN 1 THEN 'with Vendor.Io;' ELSE '' END"


@query(f"""WITH u AS (SELECT 'd' || (doc_id // 100) || '/u' || doc_id AS stem, 'pkg_' || (doc_id % 50) AS package, doc_id, text FROM documents WHERE doc_id % 3 <> 1 AND text IS NOT NULL)
    SELECT package, min(stem || '.ads') AS path, md5(arg_min(text, stem || '.ads')) AS body FROM u GROUP BY package""")
def standalone_units(spark, sf_dir):
    d = read(spark, sf_dir, "documents").where("text IS NOT NULL")
    stem = F.concat(F.lit("d"), F.floor(F.col("doc_id") / 100).cast("string"), F.lit("/u"), F.col("doc_id").cast("string"))
    k = F.col("doc_id") % 3
    spec = F.concat(F.when(k == 0, "with Ada.Text_IO, System;").when(k == 1, "with Vendor.Io;").otherwise(""), F.lit("\npackage Pkg_"), (F.col("doc_id") % 50).cast("string"), F.lit(" is\n"))
    body = F.concat(F.lit("-- "), F.regexp_replace("text", "\n", " "))
    files = d.select(F.explode(F.array(F.struct(F.concat(stem, F.lit(".ads")).alias("path"), spec.alias("text")), F.struct(F.concat(stem, F.lit(".adb")).alias("path"), body.alias("text")))).alias("f"), "text").select("f.path", "f.text", F.col("text").alias("whole"))
    found = evaluation.standalone_units(files.select("path", "text"))
    whole = files.where("path LIKE '%.ads'").select("path", "whole")
    return found.join(whole, "path").select("package", "path", F.md5("whole").alias("body"))


@query("SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower(name), '[^_.]*[_.]?'), lambda p: upper(substr(p, 1, 1)) || substr(p, 2)), '') AS shown FROM (SELECT doc_id, source || '.' || lang || '_' || upper(substr(md5(text), 1, 6)) AS name FROM documents WHERE text IS NOT NULL)")
def unit_display(spark, sf_dir):
    name = F.concat(F.col("source"), F.lit("."), F.col("lang"), F.lit("_"), F.upper(F.substring(F.md5("text"), 1, 6)))
    return read(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", evaluation.unit_display(name).alias("shown"))


@query(f"SELECT seq, kind FROM (SELECT seq, CASE seq % 4 WHEN 0 THEN 'ada_fix' WHEN 1 THEN 'typo_defect' WHEN 2 THEN 'defect_free' END AS kind FROM ({_SAMPLES})) WHERE kind IS NULL OR NOT regexp_matches(kind, '_(fix|defect)$')")
def variant_sources(spark, sf_dir):
    k = F.col("seq") % 4
    rows = _samples(spark, sf_dir).select("seq", F.when(k == 0, "ada_fix").when(k == 1, "typo_defect").when(k == 2, "defect_free").alias("kind"))
    return evaluation.variant_sources(rows)


@query("SELECT source, min(doc_id) AS doc_id FROM (SELECT source, doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3) WHERE length(text) > 200 GROUP BY source")
def first_usable(spark, sf_dir):
    return evaluation.first_usable(read(spark, sf_dir, "documents").select("source", "doc_id", "text"), "source", "doc_id", F.length("text") > 200).select("source", "doc_id")


@query("SELECT p_partkey, CAST(CASE p_brand WHEN 'Brand#3' THEN 0 WHEN 'Brand#1' THEN 1 ELSE 2 END AS INT) AS rank FROM part")
def by_priority(spark, sf_dir):
    return evaluation.by_priority(read(spark, sf_dir, "part"), "p_brand", ["Brand#3", "Brand#1"], "p_partkey").select("p_partkey", "rank")


@query("SELECT k, min(part) AS part FROM (SELECT c_custkey AS k, 0 AS part FROM customer UNION ALL SELECT o_custkey, 1 FROM orders UNION ALL SELECT p_partkey, 2 FROM part) GROUP BY k")
def ordered_union(spark, sf_dir):
    return evaluation.ordered_union(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), key="k")


@query("SELECT kind, kind_rank, id, digest FROM (SELECT 'documents' AS kind, 0 AS kind_rank, doc_id AS id, md5(text) AS digest FROM documents UNION ALL SELECT 'benchmark', 1, item_id, md5(text) FROM benchmark UNION ALL SELECT 'pages', 2, page_id, NULL FROM pages)")
def bag_union(spark, sf_dir):
    own = lambda t, k: read(spark, sf_dir, t).select(F.col(k).alias("id"), F.md5("text").alias("digest"))
    parts = {"documents": own("documents", "doc_id"), "benchmark": own("benchmark", "item_id"), "pages": read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"))}
    return evaluation.bag_union(parts, "id")


@query("""WITH t AS (SELECT DISTINCT source || '/' || lang AS path FROM documents WHERE doc_id % 2 = 0), i AS (SELECT DISTINCT CASE doc_id % 3 WHEN 0 THEN source WHEN 1 THEN source || '/' || lang ELSE source || '/other' END AS path FROM documents)
    SELECT path FROM i WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.path = i.path OR starts_with(t.path, i.path || '/'))""")
def untracked_paths(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    k, whole = F.col("doc_id") % 3, F.concat_ws("/", "source", "lang")
    path = F.when(k == 0, F.col("source")).when(k == 1, whole).otherwise(F.concat(F.col("source"), F.lit("/other")))
    return evaluation.untracked(d.select(path.alias("path")), d.where("doc_id % 2 = 0").select(whole.alias("path")))


_SHUFFLED = "row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS k, count(*) OVER () AS n"


@query(f"SELECT doc_id, CASE WHEN k < v THEN 'val' WHEN k < v + t THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, k, least(300, greatest(n // 10, 1)) AS v, least(7, greatest(n // 10, 1)) AS t FROM (SELECT doc_id, {_SHUFFLED} FROM documents))")
def fallback_carve(spark, sf_dir):
    return split.fallback_carve(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 300, 7)


@query(f"SELECT doc_id FROM (SELECT doc_id, {_SHUFFLED} FROM documents) WHERE k < 50")
def seeded_subsample(spark, sf_dir):
    return split.seeded_subsample(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 50)


@query("SELECT lang, source, count(*) AS pairs FROM documents JOIN labels USING (doc_id) GROUP BY ALL HAVING count(*) > 0")
def pairs_per_root(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id").groupBy("lang", "source").agg(F.count("*").alias("pairs"))
