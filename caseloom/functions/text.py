"""Column functions over text: cleaning, labels, tokens, redaction, identities."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: strings that count as missing ---
MISSING = ("", "NULL", "null", "None", "none", "\\N")


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends (``trim`` only knows blanks)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """Stripped text; null and the missing markers become the empty string."""
    s = strip(c.cast("string"))
    return F.coalesce(F.when(~s.isin(*MISSING), s), F.lit(""))


def join_present(sep: str, *parts: Column) -> Column:
    """Non-empty parts joined by ``sep``."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), sep)


def labelled_lines(pairs: list[tuple[str, Column]]) -> Column:
    """``label + value`` lines of the non-empty values, in order."""
    return F.array_join(F.array_compact(F.array(*(F.when(v != "", F.concat(F.lit(label), v)) for label, v in pairs))), "\n")


def month_of(c: Column) -> Column:
    """First seven characters of a time text, empty if it is shorter."""
    return F.when(F.length(c) >= 7, F.substring(c, 1, 7)).otherwise("")


def squeeze(c: Column) -> Column:
    """Without any white space: the identity of an entity."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def short_hash(c: Column, n: int = 16) -> Column:
    """First hex digits of the SHA-256 of a text."""
    return F.substring(F.sha2(c, 256), 1, n)


def letter_id(prefix: str, c: Column) -> Column:
    """``prefix`` and 16 letters a-p, which number redaction leaves alone."""
    return F.concat(F.lit(prefix), F.translate(short_hash(c), "0123456789abcdef", "abcdefghijklmnop"))


def labelled_field(text: Column, label: str, labels: list[str]) -> Column:
    """Value of ``label`` in a text of labelled lines, up to the next known label."""
    stop = "|".join(labels)
    return F.regexp_extract(text, rf"(?s)(?:^|\n){label}(.*?)(?=\n(?:{stop})|$)", 1)


def rfind(text: Column, marker: str) -> Column:
    """0-based start of the last occurrence, -1 if there is none."""
    at = F.instr(F.reverse(text), marker[::-1])
    return F.when(at > 0, F.length(text) - at - len(marker) + 1).otherwise(-1)


def json_text(c: Column) -> Column:
    """A text as a JSON string: quotes, backslashes and control characters escaped."""
    out = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for char, code in (("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(char), F.lit(code))
    rare = out
    for n in sorted(set(range(32)) - {8, 9, 10, 12, 13}):
        rare = F.replace(rare, F.lit(chr(n)), F.lit(f"\\u{n:04x}"))
    out = F.when(c.rlike(r"[\x00-\x07\x0B\x0E-\x1F]"), rare).otherwise(out)
    return F.concat(F.lit('"'), out, F.lit('"'))


class Verbatim(NamedTuple):
    """A value that is JSON already."""

    json: Column


def canonical_json(fields: dict[str, Column | dict | Verbatim]) -> Column:
    """Compact JSON object with sorted keys; values are texts, nested objects or JSON as it stands."""
    parts: list[Column] = []
    for i, name in enumerate(sorted(fields)):
        value = fields[name]
        shown = canonical_json(value) if isinstance(value, dict) else value.json if isinstance(value, Verbatim) else json_text(value)
        parts += [F.lit(("," if i else "{") + f'"{name}":'), shown]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


# --- tokens ---
_CJK = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}"


def tokens(c: Column) -> Column:
    """Overlapping bigrams of CJK runs (a single character stays), and lower-cased
    runs of ASCII letters or digits; everything else separates."""
    runs = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"[{_CJK}]+|[A-Za-z]+|[0-9]+"), 0)

    def expand(run: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(run) - 1)), lambda i: F.substring(run, i, F.lit(2)))
        return F.when(run.rlike(rf"^[{_CJK}]"), grams).otherwise(F.array(F.lower(run)))

    return F.flatten(F.transform(runs, expand))


# --- redaction ---
@dataclass(frozen=True)
class Pattern:
    """One step of the cascade: what to count, what to find, what to put, and what a text must hold for it.

    ``needs`` are literals of which a match holds one; ``digits`` says that a
    match holds ten digits in a row. Both are cheap to rule out.
    """

    counter: str
    find: str
    put: str
    needs: tuple[str, ...] = ()
    digits: bool = False


_HAN = r"\x{4E00}-\x{9FFF}"
# --- fixed values: patterns and placeholders, in the order in which they apply ---
REDACTIONS = (
    Pattern("email", r"(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "[邮箱]", ("@",)),
    Pattern("contact_name", rf"((?:联系人|联络人)(?:姓名)?\s*[:：]\s*)(?!\[姓名\])[{_HAN}·]{{2,4}}(?=[，,。；;、\s]|\[手机号\]|\d|联系电话|联系|电话|手机|$)", "$1[姓名]", ("联系人", "联络人")),
    Pattern("contact_name", rf"((?:联系人|联络人)(?:姓名)?\s*)(?![:：\s]|\[姓名\])[{_HAN}·]{{2,4}}(?=\s*[，,]?\s*(?:0?1[3-9]\d{{9,10}}|\[手机号\]))", "$1[姓名]", ("联系人", "联络人")),
    Pattern("landline", r"((?:电话|联系电话|联系方式|座机)\s*[:：]?\s*)0\d{2,3}[-－—\s]?\d{7,8}(?!\d)", "$1[座机]", ("电话", "联系方式", "座机")),
    Pattern("qq", r"(?i)((?:QQ|扣扣)\s*[:：]?\s*)[1-9]\d{4,11}(?!\d)", "$1[QQ号]", ("QQ", "qq", "Qq", "qQ", "扣扣")),
    Pattern("wechat", r"(?i)((?:微信|微信号|wechat)\s*[:：]?\s*)[A-Za-z][A-Za-z0-9_-]{5,19}", "$1[微信号]"),
    Pattern("phone", r"(?<!\d)0?1[3-9]\d{9,10}(?!\d)", "[手机号]", digits=True),
    Pattern("alnum_id", r"(?<![A-Za-z0-9])[A-Za-z]{1,6}\d{10,}[A-Za-z0-9]*(?![A-Za-z0-9])", "[业务编号]", digits=True),
    Pattern("id_card", r"(?<!\d)\d{17}[\dXx](?!\d)", "[身份证号]", digits=True),
    Pattern("long_number", r"(?<!\d)\d{18,}(?!\d)", "[长数字编号]", digits=True),
    Pattern("numeric_id", r"(?<!\d)\d{13,17}(?!\d)", "[数字编号]", digits=True),
    Pattern("name", rf"(姓名[:：]\s*)[{_HAN}·]{{2,8}}", "$1[姓名]", ("姓名",)),
)
COUNTERS = tuple(dict.fromkeys(p.counter for p in REDACTIONS))


def _unicode(pattern: str) -> str:
    """Digits and white space of any script, as the rules mean them."""
    return "(?U)" + pattern


def redact(df, column: str, out: str | None = None, counts: str | None = None):
    """``df`` with ``column`` redacted into ``out`` and, if named, a struct of counters.

    The steps are chained columns, so each pattern sees what the last one left.
    A step runs only on texts that hold what it needs; with counters it
    replaces only where it counted a match.
    """
    out = out or column
    work = df.withColumn(out, F.coalesce(F.col(column), F.lit("")))
    names: dict[str, list[str]] = {c: [] for c in COUNTERS}
    for k, step in enumerate(REDACTIONS):
        done = F.regexp_replace(out, _unicode(step.find), step.put)
        may = F.col(out).rlike(_unicode(r"\d{10}")) if step.digits else F.lit(not step.needs)
        for word in step.needs:
            may = may | F.contains(F.col(out), F.lit(word))
        if counts:
            name = f"__{out}_{k}"
            names[step.counter].append(name)
            work = work.withColumn(name, F.when(may, F.regexp_count(out, F.lit(_unicode(step.find)))).otherwise(0))
            may = F.col(name) > 0
        done = F.when(may, done).otherwise(F.col(out))
        work = work.withColumn(out, done)
    if counts:
        parts = [sum((F.col(n) for n in some[1:]), F.col(some[0])).cast("long").alias(c) for c, some in names.items()]
        work = work.withColumn(counts, F.struct(*parts)).drop(*(n for some in names.values() for n in some))
    return work


# --- fixed values: what a safety scan still looks for in redacted text ---
RESIDUALS = (
    ("phone", r"(?<!\d)0?1[3-9]\d{9,10}(?!\d)"),
    ("id_card", r"(?<!\d)\d{17}[\dXx](?!\d)"),
    ("name", rf"姓名[:：]\s*(?!\[姓名\])[{_HAN}·]{{2,8}}"),
    ("email", REDACTIONS[0].find),
    ("contact_name", REDACTIONS[1].find),
    ("contact_before_phone", REDACTIONS[2].find),
    ("landline", REDACTIONS[3].find),
    ("qq", REDACTIONS[4].find),
    ("wechat", REDACTIONS[5].find),
)


def residual_counts(c: Column) -> list[Column]:
    """One count column for each kind of personal data that may have slipped through."""
    return [F.regexp_count(c, F.lit(_unicode(p))).cast("long").alias(name) for name, p in RESIDUALS]
