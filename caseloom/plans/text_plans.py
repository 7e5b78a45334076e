"""Queries over texts, vectors and records: retrieval, cleaning, profiles, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions import text as tx
from caseloom.functions import view as vw
from caseloom.operators import evaluation as ev
from caseloom.operators import profile as pf
from caseloom.operators import retrieval as rt
from caseloom.plans.base import register
from caseloom.session import settle, table, values



def _body():
    return F.coalesce(F.col("text"), F.lit(""))


_TOKENS = "list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]+'), lambda x: lower(x))"

_NUMBER_STEPS = (("long_number", "[0-9]{18,}", "[长数字编号]"), ("numeric_id", "[0-9]{13,17}", "[数字编号]"))


def _oracle_redacted() -> str:
    """Redaction without look-around: bounds are captured, each step runs twice."""
    out = "coalesce(text, '')"
    email = "(^|[^A-Za-z0-9_.+-])[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+((?:[.][A-Za-z0-9-]+)+)"
    steps = [(email, r"\1[邮箱]")]
    steps += [(r"(^|[^0-9])0?1[3-9][0-9]{9,10}($|[^0-9])", r"\1[手机号]\2")]
    steps += [(r"(^|[^A-Za-z0-9])[A-Za-z]{1,6}[0-9]{10,}[A-Za-z0-9]*($|[^A-Za-z0-9])", r"\1[业务编号]\2")]
    steps += [(r"(^|[^0-9])[0-9]{17}[0-9Xx]($|[^0-9])", r"\1[身份证号]\2")]
    steps += [(rf"(^|[^0-9]){p}($|[^0-9])", rf"\1{put}\2") for _, p, put in _NUMBER_STEPS]
    for find, put in steps:
        for _ in range(2):
            out = f"regexp_replace({out}, '{find}', '{put}', 'g')"
    return out


# ------------------------------------------------------------------ retrieval
TERMS = "the er and of"


def bm25_sql(asked: str, keep: str = "true") -> str:
    """CTEs up to ``scored`` (query_id, doc_id, score) for a query table ``asked``."""
    return f"""
toks AS (SELECT doc_id, {keep} AS keep, {_TOKENS} AS t FROM documents),
stats AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM toks),
tf AS (SELECT doc_id, keep, dl, token, count(*) AS tf FROM (SELECT doc_id, keep, len(t) AS dl, unnest(t) AS token FROM toks) GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
asked AS ({asked}),
scored AS (
  SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5e0) / (df + 0.5e0)) * tf * 2.5e0 / (tf + 1.5e0 * (0.25e0 + 0.75e0 * dl / avgdl))), 6) AS score
  FROM tf JOIN df USING (token) JOIN asked USING (token), stats WHERE keep GROUP BY 1, 2
)"""


_ONE = f"SELECT DISTINCT 0 AS query_id, unnest(string_split('{TERMS}', ' ')) AS token"


@register("tokenize_counts", f"SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest({_TOKENS}) AS token FROM documents) GROUP BY token")
def tokenize_counts(spark, d):
    p = rt.postings(table(spark, d, "documents"), "doc_id", F.col("text"))
    return p.groupBy("token").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("docs"))


def _one(spark, d, keep=None):
    return rt.bm25(table(spark, d, "documents"), "doc_id", F.col("text"), values(spark, [(0, TERMS)], "query_id", "query"), keep)


@register("bm25_topk", f"WITH {bm25_sql(_ONE)} SELECT doc_id, score FROM scored ORDER BY score DESC, doc_id LIMIT 20")
def bm25_topk(spark, d):
    return rt.top_k(_one(spark, d), 20).select("doc_id", "score")


@register("bm25_filtered", f"WITH {bm25_sql(_ONE, keep="lang = 'de'")} SELECT doc_id, score FROM scored ORDER BY score DESC, doc_id LIMIT 20")
def bm25_filtered(spark, d):
    return rt.top_k(_one(spark, d, F.col("lang") == "de"), 20).select("doc_id", "score")


_BENCH = "SELECT DISTINCT item_id AS query_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z]+|[0-9]+'), lambda x: lower(x))) AS token FROM benchmark"


@register("bm25_batch_benchmark", f"WITH {bm25_sql(_BENCH)} SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 5")
def bm25_batch_benchmark(spark, d):
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    best = rt.top_k(rt.bm25(table(spark, d, "documents"), "doc_id", F.col("text"), asked), 5, "query_id")
    return best.select("query_id", "doc_id", "score", F.col("rank").cast("long").alias("rank"))


@register("search_result_view", f"""WITH {bm25_sql(_ONE)}, best AS (SELECT * FROM scored ORDER BY score DESC, doc_id LIMIT 20),
line AS (SELECT doc_id, score, trim(regexp_replace({{redacted}}, '[[:space:]]+', ' ', 'g')) AS s FROM best JOIN documents USING (doc_id))
SELECT doc_id, score, CASE WHEN length(s) <= 220 THEN s ELSE substr(s, 1, 217) || '...' END AS snippet FROM line""".replace("{redacted}", _oracle_redacted()))
def search_result_view(spark, d):
    best = rt.top_k(_one(spark, d), 20)
    return vw.snippet(best.join(table(spark, d, "documents").select("doc_id", "text"), "doc_id"), "text").select("doc_id", "score", "snippet")


_QUERY_VECTOR = [round(((i * 37) % 64 - 32) / 32, 5) for i in range(64)]
_COS = f"""v AS (SELECT vec_id AS doc_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e, {_QUERY_VECTOR}::DOUBLE[] AS q FROM embeddings),
c AS (SELECT doc_id, label, round(list_cosine_similarity(e, q), 6) AS score FROM v)"""


def _cosine(spark, d, keep=None):
    return rt.cosine(table(spark, d, "embeddings"), "vec_id", "embedding", _QUERY_VECTOR, keep)


@register("vector_topk", f"WITH {_COS} SELECT doc_id, score FROM c ORDER BY score DESC, doc_id LIMIT 25")
def vector_topk(spark, d):
    return rt.top_k(_cosine(spark, d), 25).select("doc_id", "score")


@register("vector_filtered_topk", f"WITH {_COS} SELECT doc_id, score FROM c WHERE label IN (1, 3) ORDER BY score DESC, doc_id LIMIT 25")
def vector_filtered_topk(spark, d):
    return rt.top_k(_cosine(spark, d, F.col("label").isin(1, 3)), 25).select("doc_id", "score")


@register("topic_analysis_facets", f"WITH {_COS}, top AS (SELECT * FROM c ORDER BY score DESC, doc_id LIMIT 100) SELECT label, count(*) AS n FROM top WHERE score >= 0.1e0 AND label <> 9 GROUP BY label")
def topic_analysis_facets(spark, d):
    """Facets of the top 100 that pass the threshold: the filter comes after the cut."""
    top = rt.top_k(_cosine(spark, d), 100)
    return top.filter((F.col("score") >= 0.1) & (F.col("label") != 9)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------- cleaning and privacy
@register("redact_documents", f"SELECT doc_id, sha256({_oracle_redacted()}) AS redacted_sha256 FROM documents")
def redact_documents(spark, d):
    return tx.redact(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", F.sha2("text", 256).alias("redacted_sha256"))


def _marks(placeholder: str) -> str:
    return f"sum((length(r) - length(replace(r, '{placeholder}', ''))) // {len(placeholder)})::BIGINT"


@register("redaction_counts", f"SELECT {_marks('[邮箱]')} AS email, {_marks('[手机号]')} AS phone, {_marks('[业务编号]')} AS alnum_id, {_marks('[身份证号]')} AS id_card, {_marks('[长数字编号]')} AS long_number, {_marks('[数字编号]')} AS numeric_id FROM (SELECT {_oracle_redacted()} AS r FROM documents)")
def redaction_counts(spark, d):
    rows = tx.redact(table(spark, d, "documents").select("doc_id", "text"), "text", counts="hits")
    return rows.agg(*(F.sum(f"hits.{c}").alias(c) for c in ("email", "phone", "alnum_id", "id_card", "long_number", "numeric_id")))


@register("safety_scan", r"""WITH t AS (SELECT 'documents' AS src, coalesce(text, '') AS x FROM documents UNION ALL SELECT 'conversations', coalesce(text, '') FROM conversations)
SELECT src, sum(len(regexp_extract_all(x, '[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+')))::BIGINT AS email, count(*) FILTER (WHERE regexp_matches(x, '(^|[^0-9])[0-9]{17}[0-9Xx]($|[^0-9])')) AS id_card_texts FROM t GROUP BY src""")
def safety_scan(spark, d):
    rows = [table(spark, d, t).select(F.lit(t).alias("src"), _body().alias("x")) for t in ("documents", "conversations")]
    counts = rows[0].unionByName(rows[1]).select("src", *tx.residual_counts(F.col("x")))
    return counts.groupBy("src").agg(F.sum("email").alias("email"), F.count(F.when(F.col("id_card") > 0, 1)).alias("id_card_texts"))


@register("clean_and_display_text", r"""SELECT c_custkey, 'name: ' || trim(c_name) || chr(10) || 'segment: ' || c_mktsegment || chr(10) || 'area: ' || r_name || ' / ' || n_name AS display, r_name || ' / ' || n_name AS area
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def clean_and_display_text(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    area = tx.join_present(" / ", tx.clean(F.col("r_name")), tx.clean(F.col("n_name")))
    lines = [("name: ", tx.clean(F.col("c_name"))), ("segment: ", tx.clean(F.col("c_mktsegment"))), ("none: ", F.lit("")), ("area: ", area)]
    return rows.select("c_custkey", tx.labelled_lines(lines).alias("display"), area.alias("area"))


@register("doc_identity", "SELECT doc_id, 'order_' || translate(substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16), '0123456789abcdef', 'abcdefghijklmnop') AS order_id FROM documents")
def doc_identity(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.letter_id("order_", F.col("doc_id").cast("string")).alias("order_id"))


@register("content_hash_dups", """WITH g AS (SELECT sha256(coalesce(lang, '') || '|' || coalesce(text, '')) AS h, count(*) AS n FROM documents GROUP BY 1)
SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_payloads, (sum(n) - count(*))::BIGINT AS beyond_first, round((sum(n) - count(*))::DOUBLE / sum(n), 6) AS rate, count(*) FILTER (WHERE n > 1) AS dup_groups, max(n)::BIGINT AS largest FROM g""")
def content_hash_dups(spark, d):
    return pf.payload_reuse(table(spark, d, "documents"), F.concat_ws("|", F.coalesce("lang", F.lit("")), _body()))


@register("content_hash_json", """SELECT doc_id, 'sha256:' || sha256('{"lang":' || to_json(coalesce(lang, '')) || ',"metadata":{"source":' || to_json(coalesce(source, '')) || '},"text":' || to_json(coalesce(text, '')) || '}') AS content_hash FROM documents""")
def content_hash_json(spark, d):
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    payload = tx.canonical_json({"text": blank("text"), "lang": blank("lang"), "metadata": {"source": blank("source")}})
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("sha256:"), F.sha2(payload, 256)).alias("content_hash"))


@register("integrity_report", """WITH t AS (SELECT *, count(*) OVER (PARTITION BY coalesce(text, '')) AS same FROM documents)
SELECT count(*) AS rows, count(*) FILTER (WHERE coalesce(text, '') = '') AS empty_texts, count(*) FILTER (WHERE n_chars <> length(text)) AS wrong_lengths, count(*) FILTER (WHERE contains(text, chr(9))) AS polluted, count(*) FILTER (WHERE same > 1) AS in_duplicate_groups, count(*) - count(DISTINCT doc_id) AS repeated_ids FROM t""")
def integrity_report(spark, d):
    docs = table(spark, d, "documents")
    count = lambda c: F.count(F.when(c, 1))
    flat = docs.agg(F.count(F.lit(1)).alias("rows"), count(_body() == "").alias("empty_texts"), count(F.col("n_chars") != F.length("text")).alias("wrong_lengths"), count(F.contains("text", F.lit("\t"))).alias("polluted"))
    groups = docs.groupBy(F.sha2(_body(), 256).alias("h")).count().agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("in_duplicate_groups"))
    ids = docs.groupBy("doc_id").count().agg((F.sum("count") - F.count(F.lit(1))).alias("repeated_ids"))
    return flat.crossJoin(groups).crossJoin(ids)  # three one-row tables


@register("legacy_field_extract", r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(url, '^([a-z]+)://', 1) AS scheme FROM pages""")
def legacy_field_extract(spark, d):
    """Fields of pages written as labelled lines and read back."""
    pages = table(spark, d, "pages").select("page_id", tx.labelled_lines([("标题：", F.regexp_extract("html", "<title>([^<]*)</title>", 1)), ("来源渠道：", F.regexp_extract("url", "^([a-z]+)://", 1))]).alias("text"))
    field = lambda label: tx.labelled_field(F.col("text"), label, ["标题：", "来源渠道："])
    return pages.select("page_id", field("标题：").alias("title"), field("来源渠道：").alias("scheme"))


# ------------------------------------------------------------------- profiles
@register("doc_length_stats", """SELECT lang, count(*) AS n, round(avg(CASE WHEN n_chars > 0 THEN 1.0e0 ELSE 0 END), 6) AS present, min(n_chars) AS lo, round(quantile_cont(n_chars, 0.5), 1) AS p50, round(quantile_cont(n_chars, 0.75), 1) AS p75, round(quantile_cont(n_chars, 0.9), 1) AS p90,
round(quantile_cont(n_chars, 0.95), 1) AS p95, round(quantile_cont(n_chars, 0.99), 1) AS p99, max(n_chars) AS hi, round(avg(n_chars), 1) AS mean FROM documents GROUP BY lang""")
def doc_length_stats(spark, d):
    return pf.length_summary(table(spark, d, "documents"), F.col("n_chars"), "lang")


@register("metadata_shape", """WITH v AS (SELECT 'lang' AS field, coalesce(lang, '') AS value FROM documents UNION ALL SELECT 'source', coalesce(source, '') FROM documents),
c AS (SELECT field, value, count(*) AS n FROM v GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY field, value = '' ORDER BY n DESC, value) AS r FROM c)
SELECT field, sum(n)::BIGINT AS rows, count(*) FILTER (WHERE value <> '') AS cardinality, count(*) FILTER (WHERE value <> '' AND n = 1) AS singletons, round(coalesce(sum(n) FILTER (WHERE value = ''), 0)::DOUBLE / sum(n), 6) AS empty_rate,
round(coalesce(sum(n) FILTER (WHERE value <> '' AND r <= 1), 0)::DOUBLE / sum(n), 6) AS top1, round(coalesce(sum(n) FILTER (WHERE value <> '' AND r <= 5), 0)::DOUBLE / sum(n), 6) AS top5, round(coalesce(sum(n) FILTER (WHERE value <> '' AND r <= 20), 0)::DOUBLE / sum(n), 6) AS top20 FROM r GROUP BY field""")
def metadata_shape(spark, d):
    return pf.metadata_shape(table(spark, d, "documents"), ["lang", "source"])


_FLAGS = (("question", r"\?"), ("shouting", "!!"), ("license", "(?i)licen[sc]e"), ("digits", "[0-9]{6}"))


@register("proxy_flags", "SELECT doc_id, array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}' END" for n, p in _FLAGS) + ", CASE WHEN len(list_filter(string_split(coalesce(text, ''), '.'), lambda x: trim(x, ' ' || chr(10)) <> '')) >= 3 THEN 'sentences' END], lambda x: x IS NOT NULL)), ',') AS flags FROM documents")
def proxy_flags(spark, d):
    hits = [F.when(_body().rlike(p), n) for n, p in _FLAGS]
    hits.append(F.when(F.size(F.filter(F.split(_body(), r"\."), lambda x: F.trim(x, F.lit(" \n")) != "")) >= 3, "sentences"))
    return table(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(F.array_compact(F.array(*hits))), ",").alias("flags"))


_BUCKET_SQL = "CASE WHEN n_chars <= 99 THEN '000-099' WHEN n_chars <= 199 THEN '100-199' WHEN n_chars <= 399 THEN '200-399' WHEN n_chars <= 599 THEN '400-599' WHEN n_chars <= 1399 THEN '600-1399' ELSE '1400+' END"


@register("head_population_drift", f"""WITH t AS (SELECT *, {_BUCKET_SQL} AS category, row_number() OVER (ORDER BY doc_id) <= 100 AS h FROM documents)
SELECT category, count(*) FILTER (WHERE h) AS head_n, count(*) AS all_n FROM t GROUP BY category""")
def head_population_drift(spark, d):
    return pf.head_drift(table(spark, d, "documents"), "doc_id", 100, pf.length_bucket(F.col("n_chars")))


_MARKERS = ("However", "The", "A")


_WINDOW = """CASE WHEN n <= 600 THEN x WHEN mark < 0 THEN substr(x, 1, 180) || substr(x, n - 420 + 1, 420)
 ELSE substr(x, 1, least(180, b)) || substr(x, b + 1, e - b) || substr(x, greatest(n - 180, e) + 1, n - greatest(n - 180, e)) END"""


@register("content_window", """WITH t AS (SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, '')) AS n FROM documents),
m AS (SELECT *, greatest(-1, """ + ", ".join(f"CASE WHEN strpos(reverse(x), reverse('{m}')) > 0 THEN n - strpos(reverse(x), reverse('{m}')) - {len(m)} + 1 ELSE -1 END" for m in _MARKERS) + f""") AS mark FROM t),
p AS (SELECT *, least(n, greatest(0, mark - 80) + 240) AS e FROM m),
q AS (SELECT *, greatest(0, least(greatest(0, mark - 80), e - 240)) AS b FROM p)
SELECT doc_id, length({_WINDOW}) AS window_chars, sha256({_WINDOW}) AS window_sha256 FROM q""")
def content_window(spark, d):
    rows = table(spark, d, "documents").select("doc_id", _body().alias("x")).select("doc_id", pf.content_window(F.col("x"), _MARKERS, 600).alias("w"))
    return rows.select("doc_id", F.length("w").cast("long").alias("window_chars"), F.sha2("w", 256).alias("window_sha256"))


@register("stratified_quota", f"""WITH t AS (SELECT doc_id, lang, {_BUCKET_SQL} AS bucket, sha256('s1␟' || CAST(doc_id AS VARCHAR)) AS rk FROM documents),
c AS (SELECT lang, bucket, count(*) AS n, count(*) * 100.0e0 / (SELECT count(*) FROM t) AS exact FROM t GROUP BY 1, 2),
q AS (SELECT *, floor(exact) AS base, row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, n DESC, lang DESC, bucket DESC) AS r FROM c),
z AS (SELECT lang, bucket, base + CASE WHEN r <= 100 - (SELECT sum(floor(exact)) FROM c) THEN 1 ELSE 0 END AS quota FROM q)
SELECT doc_id, lang, bucket FROM (SELECT *, row_number() OVER (PARTITION BY lang, bucket ORDER BY rk, doc_id) AS nth FROM t) JOIN z USING (lang, bucket) WHERE nth <= quota""")
def stratified_quota(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", pf.length_bucket(F.col("n_chars")).alias("bucket"))
    return pf.stratified(docs, ["lang", "bucket"], 100, pf.hash_rank("s1", F.col("doc_id")), "doc_id").select("doc_id", "lang", "bucket")


def _flag_arrays():
    return F.array_compact(F.array(*(F.when(_body().rlike(p), n) for n, p in _FLAGS)))


@register("challenge_round_robin")
def challenge_round_robin(spark, d):
    return pf.round_robin(table(spark, d, "documents"), "doc_id", _flag_arrays(), pf.hash_rank("s2", F.col("doc_id")), 24)


@register("latest_attempt", "SELECT conv_id, turn, role, length(text) AS chars FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def latest_attempt(spark, d):
    rows = pf.latest(table(spark, d, "conversations"), ["conv_id"], "turn")
    return rows.select("conv_id", "turn", "role", F.length("text").cast("long").alias("chars"))


@register("topn_per_stratum", "SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 10")
def topn_per_stratum(spark, d):
    rows = pf.top_per_group(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 10)
    return rows.select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber")


@register("diagnostics_summary", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total, round(quantile_cont(value, 0.5), 4) AS p50, max_by(event_id, (ts, event_id)) AS last_event FROM events GROUP BY event_type")
def diagnostics_summary(spark, d):
    events = table(spark, d, "events")
    flat = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"))
    return flat.join(pf.exact_quantiles(events, "event_type", "value", (0.5,)), "event_type", "left").withColumn("p50", F.round("q1", 4)).drop("q1")


@register("incremental_resume", "SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def incremental_resume(spark, d):
    done = table(spark, d, "labels").filter("quality = 1").select("doc_id")
    return table(spark, d, "documents").select("doc_id").join(done, "doc_id", "left_anti")


# ----------------------------------------------------------------- evaluation
_GUESS_SQL = "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS quality, CASE WHEN doc_id % 11 = 0 THEN 1 - toxic ELSE toxic END AS toxic FROM labels"


def _guess(spark, d):
    rows = table(spark, d, "labels")
    flip = lambda c, n: F.when(F.col("doc_id") % n == 0, 1 - F.col(c)).otherwise(F.col(c)).alias(c)
    return rows.select("doc_id", flip("quality", 7), flip("toxic", 11))


def _marked(rows):
    return rows.select("doc_id", F.explode(F.array_compact(F.array(F.when(F.col("quality") == 1, "quality"), F.when(F.col("toxic") == 1, "toxic")))).alias("role"))


def prf_sql(gold: str, guess: str, keys: str, by: str) -> str:
    return f"""WITH g AS ({gold}), p AS ({guess}), j AS (SELECT {by}, {keys}, g.k IS NOT NULL AS g, p.k IS NOT NULL AS p FROM (SELECT DISTINCT *, 1 AS k FROM g) g FULL JOIN (SELECT DISTINCT *, 1 AS k FROM p) p USING ({by}, {keys})),
c AS (SELECT {by}, count(*) FILTER (WHERE g AND p) AS tp, count(*) FILTER (WHERE p AND NOT g) AS fp, count(*) FILTER (WHERE g AND NOT p) AS fn FROM j GROUP BY {by})
SELECT *, round(CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END, 4) AS precision, round(CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END, 4) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0e0 * tp / (2 * tp + fp + fn) ELSE 0 END, 4) AS f1 FROM c"""


_ROLES = "SELECT doc_id, 'quality' AS role FROM {t} WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM {t} WHERE toxic = 1"


@register("prf_by_role", prf_sql(_ROLES.format(t="labels"), _ROLES.format(t=f"({_GUESS_SQL})"), "doc_id", "role"))
def prf_by_role(spark, d):
    return ev.prf(_marked(table(spark, d, "labels")), _marked(_guess(spark, d)), ["doc_id"], ["role"])


_PAIRS = "SELECT DISTINCT a.l_orderkey AS grp, a.l_suppkey AS lo, b.l_suppkey AS hi, 'all' AS role FROM {a} a JOIN {a} b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey"
_EVEN = "(SELECT * FROM lineitem WHERE l_linenumber <> 3)"


@register("pair_comembership", prf_sql(_PAIRS.format(a="lineitem"), _PAIRS.format(a=_EVEN), "grp, lo, hi", "role"))
def pair_comembership(spark, d):
    line = table(spark, d, "lineitem")
    return ev.pair_prf(line, line.filter("l_linenumber <> 3"), "l_orderkey", "l_suppkey").select(F.lit("all").alias("role"), "*")


@register("hyperedge_exact", """WITH g AS (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS m FROM lineitem GROUP BY 1), p AS (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS m FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1)
SELECT count(*) AS edges, count(*) FILTER (WHERE g.m = p.m) AS exact, count(*) FILTER (WHERE p.m IS NULL) AS missing FROM g LEFT JOIN p USING (l_orderkey)""")
def hyperedge_exact(spark, d):
    line = table(spark, d, "lineitem")
    edge = lambda rows, name: rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_suppkey")).alias(name))
    both = edge(line, "g").join(edge(line.filter("l_linenumber <> 3"), "p"), "l_orderkey", "left")
    return both.agg(F.count(F.lit(1)).alias("edges"), F.count(F.when(F.col("g") == F.col("p"), 1)).alias("exact"), F.count(F.when(F.col("p").isNull(), 1)).alias("missing"))


@register("agreement_dice", """WITH g AS (SELECT l_orderkey, list(DISTINCT l_suppkey) AS m FROM lineitem GROUP BY 1), p AS (SELECT l_orderkey, list(DISTINCT l_suppkey) AS m FROM lineitem WHERE l_linenumber <> 2 GROUP BY 1)
SELECT l_orderkey, round(2.0e0 * len(list_intersect(g.m, coalesce(p.m, []))) / (len(g.m) + len(coalesce(p.m, []))), 4) AS agreement FROM g LEFT JOIN p USING (l_orderkey)""")
def agreement_dice(spark, d):
    line = table(spark, d, "lineitem")
    one = F.collect_set("l_suppkey").alias("a")
    two = F.collect_set(F.when(F.col("l_linenumber") != 2, F.col("l_suppkey"))).alias("b")
    return line.groupBy("l_orderkey").agg(one, two).select("l_orderkey", ev.dice(F.col("a"), F.col("b")).alias("agreement"))


_QRELS_SQL = "SELECT 0 AS query_id, doc_id, 1 + toxic AS grade FROM labels WHERE quality = 1"


@register("ir_metrics", f"""WITH {bm25_sql(_ONE)}, ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored), qrels AS ({_QRELS_SQL}),
got AS (SELECT count(*) AS hits, sum((2.0e0 ** grade - 1) / log2(rank + 1.0e0)) AS dcg, min(rank) AS first FROM ranked JOIN qrels USING (query_id, doc_id) WHERE rank <= 50),
best AS (SELECT count(*) AS relevant, sum(CASE WHEN r <= 50 THEN (2.0e0 ** grade - 1) / log2(r + 1.0e0) ELSE 0 END) AS idcg FROM (SELECT *, row_number() OVER (ORDER BY grade DESC, doc_id) AS r FROM qrels))
SELECT 0 AS query_id, round(hits / 50.0e0, 4) AS p_at_k, round(hits::DOUBLE / relevant, 4) AS r_at_k, round(coalesce(dcg, 0) / idcg, 4) AS ndcg, round(coalesce(1.0e0 / first, 0), 4) AS mrr FROM got, best""")
def ir_metrics(spark, d):
    ranked = rt.top_k(_one(spark, d), 50, "query_id")
    qrels = table(spark, d, "labels").filter("quality = 1").select(F.lit(0).alias("query_id"), "doc_id", (1 + F.col("toxic")).alias("grade"))
    return ev.ir_metrics(ranked, qrels, 50)


@register("weak_gold_metrics", f"""WITH {bm25_sql(_ONE)}, ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored), gold AS (SELECT doc_id FROM documents WHERE source IN ('src2', 'src5') OR contains(coalesce(text, ''), 'License'))
SELECT count(*) AS returned, count(g.doc_id) AS hits, (SELECT count(*) FROM gold) AS gold, round(count(g.doc_id)::DOUBLE / count(*), 6) AS p_at_k, round(count(g.doc_id)::DOUBLE / (SELECT count(*) FROM gold), 6) AS r_at_k FROM ranked r LEFT JOIN gold g USING (doc_id) WHERE rank <= 100""")
def weak_gold_metrics(spark, d):
    gold = table(spark, d, "documents").filter(F.col("source").isin("src2", "src5") | F.contains(_body(), F.lit("License")))
    return ev.weak_metrics(rt.top_k(_one(spark, d), 100, "query_id"), gold, 100)


_SPECS = [(q, g, kind, value, 2) for q, (a, b) in enumerate([("Brand#11", "Brand#12"), ("Brand#13", "Brand#21"), ("Brand#33", "Brand#55")]) for g, kind, value in ((0, "brand", a), (0, "brand", b), (1, "flag", "R"))]
_MEMBERS_SQL = """SELECT {key} AS event_id, l_orderkey AS doc_id, 'brand' AS entity_type, p_brand AS value FROM lineitem JOIN part ON l_partkey = p_partkey
UNION ALL SELECT {key}, l_orderkey, 'flag', l_returnflag FROM lineitem"""
_FLAT_KEY, _LINE_KEY = "CAST(l_orderkey AS VARCHAR)", "CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)"


def rollup_sql(key: str) -> str:
    specs = ", ".join(f"({q}, {g}, '{k}', '{v}', {n})" for q, g, k, v, n in _SPECS)
    return f"""SELECT query_id, doc_id, max(matched) * 10.0e0 AS score, count(*) AS n_events FROM (
SELECT query_id, n_groups, event_id, doc_id, count(DISTINCT grp) AS got, count(DISTINCT entity_type || ':' || value) AS matched
FROM ({_MEMBERS_SQL.format(key=key)}) m JOIN (VALUES {specs}) s(query_id, grp, entity_type, value, n_groups) USING (entity_type, value) GROUP BY 1, 2, 3, 4) WHERE got = n_groups GROUP BY 1, 2"""


def _members(spark, d, key):
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    brand = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(key.alias("event_id"), F.col("l_orderkey").alias("doc_id"), F.lit("brand").alias("entity_type"), F.col("p_brand").alias("value"))
    return brand.unionByName(line.select(key.alias("event_id"), F.col("l_orderkey").alias("doc_id"), F.lit("flag").alias("entity_type"), F.col("l_returnflag").alias("value")))


def _rollup(spark, d, by_line):
    key = F.concat_ws(":", "l_orderkey", "l_linenumber") if by_line else F.col("l_orderkey").cast("string")
    return ev.oracle_rollup(_members(spark, d, key), values(spark, _SPECS, "query_id", "group", "entity_type", "value", "n_groups").drop("n_groups"))


@register("oracle_rollup_batch", rollup_sql(_LINE_KEY))
def oracle_rollup_batch(spark, d):
    return _rollup(spark, d, True)


@register("flat_vs_issue_paired", f"""WITH f AS ({rollup_sql(_FLAT_KEY)}), i AS ({rollup_sql(_LINE_KEY)})
SELECT query_id, count(f.doc_id) AS flat_docs, count(i.doc_id) AS issue_docs, count(*) FILTER (WHERE i.doc_id IS NULL) AS flat_only, count(*) FILTER (WHERE f.doc_id IS NULL) AS issue_only FROM f FULL JOIN i USING (query_id, doc_id) GROUP BY query_id""")
def flat_vs_issue_paired(spark, d):
    flat = _rollup(spark, d, False).select("query_id", "doc_id", F.lit(1).alias("f"))
    issue = _rollup(spark, d, True).select("query_id", "doc_id", F.lit(1).alias("i"))
    both = flat.join(issue, ["query_id", "doc_id"], "full_outer")
    return both.groupBy("query_id").agg(F.count("f").alias("flat_docs"), F.count("i").alias("issue_docs"), F.count(F.when(F.col("i").isNull(), 1)).alias("flat_only"), F.count(F.when(F.col("f").isNull(), 1)).alias("issue_only"))


def _oracle_cte(p: str, key: str) -> str:
    """CTEs {p}m (members) to {p}r (ranked documents) of the queries over one graph."""
    return f"""{p}m AS (SELECT DISTINCT * FROM ({_MEMBERS_SQL.format(key=key)})),
{p}h AS (SELECT query_id, event_id, doc_id, count(DISTINCT grp) AS got, list(DISTINCT entity_type || ':' || value) AS names FROM {p}m JOIN specs USING (entity_type, value) GROUP BY 1, 2, 3),
{p}s AS (SELECT * FROM {p}h WHERE got >= CASE WHEN query_id = 2 THEN 1 ELSE 2 END),
{p}f AS (SELECT DISTINCT query_id, entity_type, value FROM {p}s JOIN {p}m USING (event_id) WHERE entity_type = 'brand' AND query_id <> 1),
{p}x AS (SELECT f.query_id, m.event_id, m.doc_id, list(DISTINCT entity_type || ':' || value) AS names FROM {p}f f JOIN {p}m m USING (entity_type, value)
  WHERE NOT EXISTS (SELECT 1 FROM {p}s s WHERE s.query_id = f.query_id AND s.event_id = m.event_id) GROUP BY 1, 2, 3),
{p}e AS (SELECT query_id, doc_id, 'seed_entity' AS stage, len(names) * 10.0e0 AS score, names FROM {p}s UNION ALL SELECT query_id, doc_id, 'one_hop_expansion', len(names) * 3.0e0 - 5.0e0, names FROM {p}x),
{p}d AS (SELECT query_id, doc_id, max(stage) AS match_stage, max(score) AS score, count(*) FILTER (WHERE stage = 'seed_entity') AS seed_events, count(*) FILTER (WHERE stage <> 'seed_entity') AS expanded_events,
  array_to_string(list_sort(list_distinct(flatten(list(names)))), ',') AS entities FROM {p}e GROUP BY 1, 2),
{p}c AS (SELECT *, row_number() OVER (PARTITION BY query_id, match_stage ORDER BY score DESC, doc_id) AS nth FROM {p}d),
{p}r AS (SELECT * EXCLUDE (nth), row_number() OVER (PARTITION BY query_id ORDER BY score DESC, match_stage DESC, doc_id) AS rank FROM {p}c WHERE match_stage = 'seed_entity' OR nth <= 40)"""


_SPECS_CTE = "specs(query_id, grp, entity_type, value) AS (VALUES " + ", ".join(f"({q}, {g}, '{k}', '{v}')" for q, g, k, v, _ in _SPECS) + ")"
_GRADES_CTE = "grades AS (SELECT o_orderkey % 3 AS query_id, o_orderkey AS doc_id, 1 + o_orderkey % 2 AS grade FROM orders WHERE o_orderkey % 7 < 2)"


def _oracle(spark, d, by_line, ask=ev.oracle_query, *columns):
    """Three queries: AND with a hop, AND without, OR with a hop."""
    key = F.concat_ws(":", "l_orderkey", "l_linenumber") if by_line else F.col("l_orderkey").cast("string")
    specs = values(spark, _SPECS, "query_id", "group", "entity_type", "value", "n_groups").drop("n_groups")
    queries = values(spark, [(0, 2, "AND", ["brand"], 40), (1, 2, "AND", [], 40), (2, 2, "OR", ["brand"], 40)], "query_id", "n_groups", "operator", "frontier", "max_expanded")
    return ask(_members(spark, d, key), specs, queries, *columns)


def _ranked(spark, d, by_line):
    return _oracle(spark, d, by_line, ev.oracle_query, "match_stage")


def _grades(spark, d):
    key = F.col("o_orderkey")
    return table(spark, d, "orders").filter(key % 7 < 2).select((key % 3).cast("int").alias("query_id"), key.alias("doc_id"), (1 + key % 2).alias("grade"))


@register("oracle_query_batch", f"WITH {_SPECS_CTE}, {_oracle_cte('issue_', _LINE_KEY)} SELECT query_id, doc_id, match_stage, score, seed_events, expanded_events, entities, rank FROM issue_r")
def oracle_query_batch(spark, d):
    return _oracle(spark, d, True).select("query_id", "doc_id", "match_stage", "score", "seed_events", "expanded_events", F.array_join("matched_entities", ",").alias("entities"), F.col("rank").cast("long").alias("rank"))


def _metrics_sql(p: str) -> str:
    at = ", ".join(f"round(coalesce(hits_{k}, 0) / {k}.0e0, 4) AS precision_{k}, round(coalesce(hits_{k}, 0)::DOUBLE / relevant, 4) AS recall_{k}, round(CASE WHEN idcg_{k} > 0 THEN coalesce(dcg_{k}, 0) / idcg_{k} ELSE 0 END, 4) AS ndcg_{k}" for k in (5, 10))
    sums = ", ".join(f"count(grade) FILTER (WHERE rank <= {k}) AS hits_{k}, sum((2.0e0 ** grade - 1) / log2(rank + 1.0e0)) FILTER (WHERE rank <= {k}) AS dcg_{k}" for k in (5, 10))
    best = ", ".join(f"sum((2.0e0 ** grade - 1) / log2(r + 1.0e0)) FILTER (WHERE r <= {k}) AS idcg_{k}" for k in (5, 10))
    return f"""{p}got AS (SELECT query_id, {sums}, min(rank) FILTER (WHERE grade IS NOT NULL) AS first, count(*) AS retrieved, count(*) FILTER (WHERE match_stage = 'seed_entity') AS seeds, count(*) FILTER (WHERE match_stage <> 'seed_entity') AS hops,
  count(grade) FILTER (WHERE match_stage = 'seed_entity') AS good_seeds, count(grade) FILTER (WHERE match_stage <> 'seed_entity') AS good_hops FROM {p}r LEFT JOIN grades USING (query_id, doc_id) GROUP BY 1),
{p}best AS (SELECT query_id, count(*) AS relevant, {best} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, doc_id) AS r FROM grades) GROUP BY 1),
{p}met AS (SELECT query_id, {at}, round(coalesce(1.0e0 / first, 0), 4) AS mrr, relevant, coalesce(retrieved, 0) AS retrieved, coalesce(seeds, 0) AS seeds, coalesce(hops, 0) AS hops,
  round(coalesce(good_seeds, 0)::DOUBLE / relevant, 4) AS seed_recall, CASE WHEN coalesce(seeds, 0) > 0 THEN round((seeds - good_seeds)::DOUBLE / seeds, 4) ELSE 0.0e0 END AS false_seed_rate,
  CASE WHEN coalesce(hops, 0) > 0 THEN round(good_hops::DOUBLE / hops, 4) END AS one_hop_precision, CASE WHEN coalesce(hops, 0) > 0 THEN round((hops - good_hops)::DOUBLE / hops, 4) END AS erroneous_expansion_rate FROM {p}best LEFT JOIN {p}got USING (query_id))"""


@register("oracle_metrics", f"WITH {_SPECS_CTE}, {_GRADES_CTE}, {_oracle_cte('issue_', _LINE_KEY)}, {_metrics_sql('issue_')} SELECT * FROM issue_met")
def oracle_metrics(spark, d):
    return ev.oracle_metrics(_ranked(spark, d, True), _grades(spark, d))


_METRICS = [f"{m}_{k}" for k in (5, 10) for m in ("precision", "recall", "ndcg")] + ["mrr", "seed_recall", "false_seed_rate", "one_hop_precision", "erroneous_expansion_rate"]
_MODES_SQL = f"WITH {_SPECS_CTE}, {_GRADES_CTE}, {_oracle_cte('flat_', _FLAT_KEY)}, {_oracle_cte('issue_', _LINE_KEY)}"


@register("oracle_macro_deltas", f"{_MODES_SQL}, {_metrics_sql('flat_')}, {_metrics_sql('issue_')}, both_sides AS (" + " UNION ALL ".join(f"SELECT '{m}' AS metric, (SELECT round(avg({m}), 4) FROM flat_met) AS flat, (SELECT round(avg({m}), 4) FROM issue_met) AS issue_aware" for m in _METRICS) + ") SELECT *, round(issue_aware - flat, 4) AS delta FROM both_sides")
def oracle_macro_deltas(spark, d):
    grades = _grades(spark, d)
    return ev.macro_deltas(*(ev.oracle_metrics(_ranked(spark, d, by_line), grades) for by_line in (False, True)))


@register("oracle_paired_effects", f"""{_MODES_SQL}, j AS (SELECT f.match_stage AS a, i.match_stage AS b, g.doc_id IS NOT NULL AS good FROM flat_r f FULL JOIN issue_r i USING (query_id, doc_id) LEFT JOIN grades g USING (query_id, doc_id)),
k AS (SELECT *, a = 'seed_entity' AND coalesce(b <> 'seed_entity', true) AS so, a = 'one_hop_expansion' AND b IS NULL AS fo, b = 'one_hop_expansion' AND a IS NULL AS io FROM j)
SELECT count(*) FILTER (WHERE so) AS flat_only_seed_docs, count(*) FILTER (WHERE a = 'one_hop_expansion' AND b = 'seed_entity') AS flat_expansion_promoted_to_issue_seed,
count(*) FILTER (WHERE so AND NOT good) AS removed_irrelevant_flat_seed_docs, count(*) FILTER (WHERE so AND good) AS lost_relevant_flat_seed_docs,
count(*) FILTER (WHERE fo AND NOT good) AS removed_irrelevant_flat_expansion_docs, count(*) FILTER (WHERE fo AND good) AS lost_relevant_flat_expansion_docs,
count(*) FILTER (WHERE io AND NOT good) AS new_irrelevant_issue_expansion_docs, count(*) FILTER (WHERE io AND good) AS new_relevant_issue_expansion_docs,
count(*) FILTER (WHERE b IS NULL AND NOT good) AS removed_irrelevant_flat_result_docs, count(*) FILTER (WHERE b IS NULL AND good) AS lost_relevant_flat_result_docs,
count(*) FILTER (WHERE a IS NULL AND NOT good) AS new_irrelevant_issue_result_docs, count(*) FILTER (WHERE a IS NULL AND good) AS new_relevant_issue_result_docs FROM k""")
def oracle_paired_effects(spark, d):
    return ev.paired_effects(*(_oracle(spark, d, by_line, ev.oracle_kept, "match_stage") for by_line in (False, True)), _grades(spark, d))


@register("ledger_transitions", """WITH s AS (SELECT l_orderkey, coalesce(list(DISTINCT l_suppkey) FILTER (WHERE l_linenumber <= 3), []) AS raw, coalesce(list(DISTINCT l_suppkey) FILTER (WHERE l_linenumber >= 2), []) AS fin, coalesce(list(DISTINCT l_suppkey) FILTER (WHERE l_returnflag = 'N'), []) AS gold FROM lineitem GROUP BY 1),
p AS (SELECT gold, list_intersect(raw, fin) AS kept, list_filter(raw, lambda x: NOT list_contains(fin, x)) AS removed, list_filter(fin, lambda x: NOT list_contains(raw, x)) AS added FROM s)
SELECT """ + ", ".join(f"sum(len(list_intersect({p}, gold)))::BIGINT AS {p}_correct, sum(len(list_filter({p}, lambda x: NOT list_contains(gold, x))))::BIGINT AS {p}_incorrect" for p in ("kept", "removed", "added")) + " FROM p")
def ledger_transitions(spark, d):
    some = lambda cond, name: F.collect_set(F.when(cond, F.col("l_suppkey"))).alias(name)
    sets = table(spark, d, "lineitem").groupBy("l_orderkey").agg(some(F.col("l_linenumber") <= 3, "raw"), some(F.col("l_linenumber") >= 2, "fin"), some(F.col("l_returnflag") == "N", "gold"))
    parts = ev.transitions(F.col("raw"), F.col("fin"), F.col("gold"))
    return sets.agg(*(F.sum(c).alias(n) for n, c in parts.items()))
