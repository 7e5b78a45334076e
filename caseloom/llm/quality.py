"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a Boolean expression over the text alone. A bounded sample gives
every rule a cost (measured time) and a selectivity (share rejected); rules
then stand in order of rejection per cost inside one CASE, so that Spark
evaluates an expensive rule only for texts that the cheap ones let through.
The order changes the time, never the verdict: a text stays if no rule fires.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import table

#: Rows that costs and selectivities are estimated on, of texts up to this many bytes.
SAMPLE_ROWS = 512
SAMPLE_BYTES = 1 << 18
#: One row in so many is taken, so that the sample is not the table's first rows.
SAMPLE_EVERY = 8
#: The sample is gone through so many times in one timed job, for the job itself takes time too.
SAMPLE_REPEATS = 4
MIN_WORDS = 50
WINDOW = 3
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Up to so many different repeated windows are looked up one by one.
FEW = 24


def words_of(text: Column) -> Column:
    """Runs of anything but the six white-space characters."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.transform(F.array(value), use)[0]


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def _n_dup(lines: Column) -> Column:
    return F.size(lines) - F.size(F.array_distinct(lines))


def _n_repeat_words(words: Column) -> Column:
    """Words inside a window of three words that occurs at least twice.

    Windows are compared by a 64-bit hash within one text. Texts without a
    repeated window end after a hash-set pass. Few different repeated windows
    are looked up one by one; many are found by sorting (hash, position)
    pairs, so cost is n log n at most for any text.
    """
    n = F.size(words)
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")), lambda acc: acc["n"])

    def by_sort(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        same = lambda j, k: F.get(pairs, j)["g"] == F.get(pairs, k)["g"]
        flagged = F.transform(F.sequence(F.lit(0), last), lambda j: F.when(((j > 0) & same(j, j - 1)) | ((j < last) & same(j, j + 1)), F.get(pairs, j)["i"]))
        return covered(F.sort_array(F.array_compact(flagged)))

    def repeated(sorted_grams: Column) -> Column:
        shifted = F.slice(sorted_grams, 2, F.size(sorted_grams))
        return F.array_distinct(F.array_compact(F.zip_with(sorted_grams, shifted, lambda a, b: F.when(a == b, a))))

    def count(g: Column) -> Column:
        by_lookup = lambda d: covered(F.array_compact(F.transform(g, lambda x, i: F.when(F.array_contains(d, x), i))))
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        hot = bound(bound(F.sort_array(g), repeated), lambda d: F.when(F.size(d) <= FEW, by_lookup(d)).otherwise(bound(pairs, by_sort)))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(hot)

    return bound(grams, count).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base figures of every row, with the text as column body.

    A null text counts as empty: all figures 0. Only the two named columns
    are read.
    """
    rows = docs.select(F.col(id_col).alias("row_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows = rows.withColumn("words", words_of(F.col("body")))
    return rows.select(
        "row_id",
        "body",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        bound(_lines_with_words(F.col("body")), _n_dup).cast("long").alias("n_dup_lines"),
        _n_repeat_words(F.col("words")).alias("n_repeat_words"),
    )


class Text:
    """What rules see of a text: the text and its words, figures on demand.

    ``known`` has columns with figures that are already there.
    """

    def __init__(self, body: Column, words: Column | None = None, **known: Column):
        self.body, self.words, self.known = body, words, known

    def _get(self, name: str, make) -> Column:
        return self.known[name] if name in self.known else make()

    @property
    def n_words(self) -> Column:
        return self._get("n_words", lambda: F.size(self.words))

    @property
    def word_chars(self) -> Column:
        return self._get("word_chars", lambda: F.length(F.array_join(self.words, "")))

    @property
    def n_symbols(self) -> Column:
        return self._get("n_symbols", lambda: F.regexp_count(self.body, F.lit(SYMBOLS)))

    @property
    def n_repeat_words(self) -> Column:
        return self._get("n_repeat_words", lambda: _n_repeat_words(self.words))

    def count(self, pattern: str) -> Column:
        return F.regexp_count(self.body, F.lit(pattern))


@dataclass(frozen=True)
class Rule:
    """``rejects(text: Text)`` is a Boolean column, never null."""

    name: str
    rejects: Callable[[Text], Column]


#: Marks of Markdown lists, headings and quotes at a line's start (after \n alone), and table bars.
MARKUP = r"(?md)^[ \t]*[#*>-]+[ \t]|(?:^|[ \t])\|(?:[ \t]|$)"
#: Scripts written without spaces: Thai to Tibetan, Myanmar, Khmer, kana, Han.
UNSPACED = r"[\x{0E00}-\x{0FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{20000}-\x{2FFFF}]"

#: Besides the base rules; all are far from what clean prose of any language shows.
RULES = (
    Rule("symbols", lambda t: (t.n_symbols * 100 > t.n_words * 10) & (F.regexp_count(F.regexp_replace(t.body, MARKUP, " "), F.lit(SYMBOLS)) * 100 > t.n_words * 10)),
    Rule("capitals", lambda t: t.count(r"\p{Lu}") * 100 > t.word_chars * 40),
    Rule("shouting", lambda t: t.count("!") * 100 > t.n_words * 50),
    Rule("digits", lambda t: t.count("[0-9]") * 100 > t.word_chars * 40),
    Rule("repeated_lines", lambda t: bound(_lines_with_words(t.body), lambda x: _n_dup(x) * 100 > F.size(x) * 60)),
    Rule("word_length", lambda t: (t.word_chars < t.n_words * 2) | ((t.word_chars > t.n_words * 25) & (t.count(UNSPACED) * 2 < t.word_chars))),
)
BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < MIN_WORDS),
    Rule("repeated_words", lambda t: t.n_repeat_words * 100 > t.n_words * 50),
)


def _sample(texts: DataFrame, rows: int) -> DataFrame:
    """Up to ``rows`` of column body as a local table, without a Python worker.

    The driver asks for a first partition, then for more until it has enough,
    so a table of any size costs a few tasks and at most ``rows`` times
    ``SAMPLE_BYTES`` bytes.
    """
    spark = texts.sparkSession
    some = texts.select("body").filter(F.octet_length("body") <= SAMPLE_BYTES)
    few = some.sample(1 / SAMPLE_EVERY, 17)._jdf
    return DataFrame(spark._jsparkSession.createDataFrame(few.takeAsList(rows), few.schema()), spark)


def cascade_order(texts: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost on a sample of about ``sample_rows`` of column body.

    A rule's cost is the time of a job that goes through the sample
    ``SAMPLE_REPEATS`` times, less that of the same job without a rule. An
    empty sample leaves the order as it is.
    """
    sample = _sample(texts, sample_rows)
    hits = lambda rules: [F.count(F.when(verdict(F.col("body"), [r]).isNotNull(), 1)) for r in rules]
    n, *found = sample.select(F.count(F.lit(1)), *hits(rules)).first()
    if not n:
        return list(rules)
    again = sample.select("body", F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_REPEATS))).alias("nth"))

    def seconds(*what: Column) -> float:
        job = again.select(F.max(F.length("body")), *what)
        job.first()  # compiles
        began = time.perf_counter()
        job.first()
        return time.perf_counter() - began

    idle = min(seconds(), seconds())
    scores = [(-(hit + 0.5) / (n + 1) / max(seconds(*hits([rule])) - idle, 1e-4), k) for k, (rule, hit) in enumerate(zip(rules, found, strict=True))]
    return [rules[k] for _, k in sorted(scores)]


def verdict(body: Column, rules: list[Rule], **known: Column) -> Column:
    """Name of the first rule that rejects, else null; later rules are not evaluated."""

    def chain(text: Text) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(rules):
            out = F.when(rule.rejects(text), F.lit(rule.name)).otherwise(out)
        return out

    if known:
        return chain(Text(body, **known))
    return bound(words_of(body), lambda words: chain(Text(body, words)))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Figures and verdict of every row, one row each; an empty table gives none.

    Null and empty texts have figures 0 and fail the base rule. Repeated rows
    each get their own row; extra columns are not read.
    """
    rows = measures(docs, id_col, text_col)
    order = cascade_order(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("body")), rules, sample_rows)
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    rows = rows.withColumn("base_failed", base)
    known = {name: F.col(name) for name in ("n_words", "word_chars", "n_symbols", "n_repeat_words")}
    kept = F.when(F.col("base_failed"), False).when(verdict(F.col("body"), order, **known).isNotNull(), False).otherwise(True)
    return rows.select(F.col("row_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE_RULES + RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the rows that any rule rejects, columns as they were.

    Null and empty texts have no words and go; rows with equal texts are
    judged alike; long texts are judged whole; an empty table stays empty;
    extra columns pass through. Ties of rules change nothing but time.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    order = cascade_order(docs.select(text.alias("body")), rules, sample_rows)
    return docs.filter(verdict(text, order).isNull())


def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


QUERIES = {"op8_quality_cascade": op8_quality_cascade}
ORACLE_SQL = {
    "op8_quality_cascade": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS k,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM t WHERE len(words) >= 3)
), hot AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM grams) WHERE n >= 2
), cover AS (
  SELECT k, count(DISTINCT i + o) AS n FROM hot, (VALUES (0), (1), (2)) AS offs(o) GROUP BY k
), base AS (
  SELECT doc_id, body, lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(body) - length(translate(body, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM t LEFT JOIN cover USING (k)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR len(regexp_extract_all(regexp_replace(body, '{MARKUP}', ' ', 'g'), '[#*$%&|<>]')) * 100 > n_words * 10 AND n_symbols * 100 > n_words * 10
            OR len(regexp_extract_all(body, '\p{Lu}')) * 100 > word_chars * 40
            OR (length(body) - length(translate(body, '!', ''))) * 100 > n_words * 50
            OR len(regexp_extract_all(body, '[0-9]')) * 100 > word_chars * 40
            OR n_dup_lines * 100 > len(lines) * 60
            OR word_chars < n_words * 2
            OR word_chars > n_words * 25 AND len(regexp_extract_all(body, '{UNSPACED}')) * 2 < word_chars) AS kept
FROM base
""".replace("{MARKUP}", MARKUP.replace("(?md)", "(?m)")).replace("{UNSPACED}", UNSPACED)
}
