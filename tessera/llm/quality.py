"""Quality rules whose thresholds come from mergeable quantile sketches per language and source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, checkpoint, let, set_aside, small, stored, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """An integer measure (per mille or hundredths) with the fences of its far outliers.

    A document fails above ``q3 + reach * spread`` and, if ``both``, below ``q1 - reach * spread``, where the
    quartiles are those of its language and source and spread is ``q3 - q1``, but ``least`` at least.
    """

    name: str
    least: int
    both: bool = False


#: Mean word length in hundredths, then symbols per mille of words, capitals A-Z per mille of words' characters, repeated lines
#: per mille of lines, repeated words per mille of words.
RULES = (
    Rule("word_len", 60, both=True),
    Rule("symbol_rate", 60),
    Rule("upper_rate", 40),
    Rule("line_rate", 100),
    Rule("repeat_rate", 80),
)
REACH = 4
#: A language's quartiles count as much as so many documents of each of its groups, and those of all documents as much as so many of a language.
#: So the fewer documents a group has, the more it is judged by its language, by degrees and alike at every size.
PRIOR_DOCS = 200


def measures(text: Column) -> Column:
    """A struct of the base counts of one text: all bigint; a null text counts as empty.

    Repeated 3-word windows are found without a join: each window's hash and its position are packed into
    one bigint, of which only as many low bits as the text needs hold the position, and the array is sorted. Windows whose hashes are
    neighbours are compared word by word; should hashes have met by chance, the text's windows are sorted by their words instead. The words that
    repeated windows cover are counted from the gaps between them.
    """
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    gone = lambda chars: F.length(F.translate(t, chars, ""))

    def of(ws: Column) -> Column:
        n = F.size(ws)
        return F.struct(
            n.cast("bigint").alias("n_words"),
            gone(SPACES).cast("bigint").alias("word_chars"),
            (F.length(t) - gone(SYMBOLS)).cast("bigint").alias("n_symbols"),
            (F.length(t) - gone("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("bigint").alias("n_upper"),
            let(lines, lambda x: F.struct(
                (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"), F.size(x).cast("bigint").alias("n_lines")
            )).alias("l"),
            F.when(n < 4, F.lit(0)).otherwise(let(F.length(F.bin(n.cast("bigint"))), lambda b: repeated_words(ws, b))).cast("bigint").alias("n_repeat_words"),
        )

    return let(words(t), of)


def window_hash(ws: Column, i: Column) -> Column:
    return F.xxhash64(ws[i], ws[i + 1], ws[i + 2])


def repeated_words(ws: Column, bits: Column, hash_of=window_hash) -> Column:
    """The number of words in 3-word windows that occur twice or more, exactly; ``bits`` are enough for a position."""
    every = F.sequence(F.lit(0), F.size(ws) - 3)
    keys = F.sort_array(F.transform(every, lambda i: F.call_function("shiftleft", hash_of(ws, i), bits).bitwiseOR(i.cast("bigint"))))
    low = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1).cast("int")
    high = lambda x: F.call_function("shiftrightunsigned", x, bits)
    following = F.sequence(F.lit(1), F.size(ws) - 3)

    def same(i: Column, j: Column) -> Column:
        return (ws[i] == ws[j]) & (ws[i + 1] == ws[j + 1]) & (ws[i + 2] == ws[j + 2])

    def covered(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p)), lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda a, x: a + x))

    def starts(at: Column, place) -> Column:
        return F.sort_array(F.array_distinct(F.concat(F.transform(at, lambda k: place(k - 1)), F.transform(at, place))))

    def by_words() -> Column:
        windows = F.sort_array(F.transform(every, lambda i: F.struct(F.array_join(F.slice(ws, i + 1, 3), " ").alias("w"), i.alias("i"))))
        return let(windows, lambda s: let(F.filter(following, lambda k: s[k - 1]["w"] == s[k]["w"]), lambda at: let(starts(at, lambda k: s[k]["i"]), covered)))

    def of(s: Column) -> Column:
        def counted(at: Column) -> Column:
            exact = F.forall(at, lambda k: same(low(s[k - 1]), low(s[k])))
            return F.when(exact, let(starts(at, lambda k: low(s[k])), covered)).otherwise(by_words())

        return let(F.filter(following, lambda k: high(s[k - 1]) == high(s[k])), counted)

    return let(keys, of)


def sketch_bin(value: str, shift: str = "shiftleft(CAST(1 AS BIGINT), {})") -> str:
    """SQL for the lower end of a value's bin: exact below 256, then within 1/64 of the value, however large; ``shift`` is the engine's way to write 2 to a power."""
    return f"CASE WHEN {value} < 256 THEN {value} ELSE {value} - {value} % ({shift.format(f'CAST(length(bin({value})) - 7 AS INT)')}) END"


#: SQL for the measures from the base counts; div is the name of integer division.
RATES = {
    "word_len": ("word_chars * 100", "n_words"),
    "symbol_rate": ("n_symbols * 1000", "n_words"),
    "upper_rate": ("n_upper * 1000", "word_chars"),
    "line_rate": ("n_dup_lines * 1000", "n_lines"),
    "repeat_rate": ("n_repeat_words * 1000", "n_words"),
}


def rated(docs: DataFrame) -> DataFrame:
    """``docs`` with columns ``q_<base count>``, ``q_base_failed`` and ``q_<rate>``; existing q_ columns are replaced."""
    m = docs.withColumn("q_m", measures(F.col("text")))
    base = {c: F.col(f"q_m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_upper", "n_repeat_words")}
    base |= {c: F.col(f"q_m.l.{c}") for c in ("n_dup_lines", "n_lines")}
    out = m.withColumns({f"q_{k}": v for k, v in base.items()}).drop("q_m")
    named = lambda s: F.expr(" ".join(f"q_{x}" if x[0].isalpha() else x for x in s.split()))
    rates = {f"q_{k}": F.floor(named(a) / F.greatest(named(b), F.lit(1))).cast("bigint") for k, (a, b) in RATES.items()}
    failed = F.expr("q_n_words < 50 OR 100 * q_n_repeat_words > 50 * q_n_words")
    return out.withColumns(rates | {"q_base_failed": failed})


def thresholds(rates: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, lo_<rate>, hi_<rate>): the fences of each language and source.

    The sketch of a group is the count of its documents in each bin of each rate. Sketches merge by adding counts, so
    the shuffle carries at most one row per group, rate, bin and task, whatever share of the rows one source
    has; the sketch of a language or of everything is the sum of its groups' sketches. Documents that fail the base rules are
    left out, so that junk doesn't widen the fences. A null language or source is a group of its own.
    """
    names = [r.name for r in RULES]
    pairs = ", ".join(f"'{n}', {sketch_bin(f'q_{n}')}" for n in names)
    seen = (
        rates.where("NOT q_base_failed")
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.expr(f"stack({len(names)}, {pairs}) AS (rate, bin)"))
        .groupBy("lang", "source", "rate", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    return rates.sparkSession.sql(threshold_sql("{seen}", "div"), seen=seen)


def threshold_sql(sketches: str, div: str) -> str:
    """SQL from sketches (lang, source, rate, bin, n) to fences; ``div`` is the engine's integer division."""
    fences = ", ".join(
        f"max(CASE WHEN rate = '{r.name}' THEN " + (f"q1 - {REACH} * greatest(q3 - q1, {r.least})" if r.both else "-1") + f" END) AS lo_{r.name}, "
        f"max(CASE WHEN rate = '{r.name}' THEN q3 + {REACH} * greatest(q3 - q1, {r.least}) END) AS hi_{r.name}"
        for r in RULES
    )
    quartiles = "min(CASE WHEN 4 * upto >= total THEN bin END) AS q1, min(CASE WHEN 4 * upto >= 3 * total THEN bin END) AS q3"

    def level(keys: str, name: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""{name}_bins AS (SELECT {by}rate, bin, CAST(sum(n) AS BIGINT) AS n FROM {sketches} GROUP BY {by}rate, bin),
{name}_sums AS (SELECT {by}rate, bin, sum(n) OVER (PARTITION BY {by}rate ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}rate) AS total FROM {name}_bins),
{name}_q AS (SELECT {by}rate, max(total) AS docs, {quartiles} FROM {name}_sums GROUP BY {by}rate)"""

    def blend(own: str, wide: str, c: str) -> str:
        return f"({own}.docs * {own}.{c} + {PRIOR_DOCS} * {wide}.{c}) {div} ({own}.docs + {PRIOR_DOCS}) AS {c}"

    return f"""WITH {level("lang, source", "grp")}, {level("lang", "lng")}, {level("", "everything")},
tongue AS (SELECT l.lang, l.rate, {blend("l", "a", "q1")}, {blend("l", "a", "q3")} FROM lng_q l JOIN everything_q a ON l.rate = a.rate),
chosen AS (SELECT g.lang, g.source, g.rate, {blend("g", "t", "q1")}, {blend("g", "t", "q3")} FROM grp_q g
JOIN tongue t ON g.lang IS NOT DISTINCT FROM t.lang AND g.rate = t.rate)
SELECT lang, source, {fences} FROM chosen GROUP BY lang, source"""


def verdict(prefix: str = "q_") -> str:
    """SQL that is true if no rate is beyond its fences."""
    return " AND ".join(f"{prefix}{r.name} BETWEEN lo_{r.name} AND hi_{r.name}" for r in RULES)


def judge(rates: DataFrame, fences: DataFrame) -> DataFrame:
    """``rates``, a result of ``rated``, with ``q_kept`` instead of its rates; ``fences`` is a result of ``thresholds``.

    ``rates`` needs lang and source; other columns pass through. Rows are judged one by one, so repeated rows stay repeated. An
    empty table gives an empty result. A group of which no document passes the base rules has no
    fences, and nothing in it is kept. The fences, a row for each language and source, are broadcast when a count shows that they are few;
    otherwise the join shuffles, and adaptive execution splits a hot source.
    """
    names = {c: f"q_t_{c}" for c in ("lang", "source")}
    fences = small(fences.withColumnsRenamed(names))
    same = F.col("lang").eqNullSafe(F.col("q_t_lang")) & F.col("source").eqNullSafe(F.col("q_t_source"))
    kept = F.coalesce(F.expr(f"NOT q_base_failed AND {verdict()}"), F.lit(False))
    drop = [*names.values(), *(f"{e}_{r.name}" for r in RULES for e in ("lo", "hi")), *(f"q_{r.name}" for r in RULES)]
    return rates.join(fences, same, "left").withColumn("q_kept", kept).drop(*drop)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, lang, source and any other columns) that the rules keep, with the columns of ``docs``.

    A null text counts as empty, and an empty text fails the base rule on words. Each text is measured once and never shuffled: rows and rates are written to the shared folder, from which the sketches read
    the rates alone.
    """
    inner = set_aside(docs, "text", "lang", "source")
    rates = stored(rated(inner))
    return judge(rates, checkpoint(thresholds(rates))).where("q_kept").select(*inner.columns).toDF(*docs.columns)


def quality_table(docs: DataFrame) -> DataFrame:
    """(doc_id, base counts, base_failed, kept) for each row of ``docs``; each text is scanned once.

    A null text counts as empty and fails the base rule on words. Rows are judged one by one, so repeated rows stay repeated; a null language or
    source is a group of its own; an empty table gives an empty result; other columns are not read.
    """
    narrow = rated(docs.select("doc_id", "text", "lang", "source")).drop("text")
    narrow = checkpoint(narrow)
    out = judge(narrow, checkpoint(thresholds(narrow)))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select("doc_id", *(F.col(f"q_{c}").alias(c) for c in base))


#: DuckDB SQL for ``quality_table``.
ORACLE = f"""WITH d AS (
SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w FROM (SELECT r, ws, unnest(range(1, CAST(len(ws) - 1 AS BIGINT))) AS i FROM d WHERE len(ws) > 2)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 3)) AS k) GROUP BY r),
b AS (SELECT d.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS q_n_words,
CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS q_word_chars,
CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS q_n_symbols,
CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS q_n_upper,
CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS q_n_dup_lines, CAST(len(lines) AS BIGINT) AS q_n_lines,
CAST(coalesce(cov.n, 0) AS BIGINT) AS q_n_repeat_words FROM d LEFT JOIN cov ON d.r = cov.r),
m AS (SELECT *, q_n_words < 50 OR 100 * q_n_repeat_words > 50 * q_n_words AS q_base_failed,
{", ".join(f"({' '.join(f'q_{x}' if x[0].isalpha() else x for x in a.split())}) // greatest(q_{b}, 1) AS q_{k}" for k, (a, b) in RATES.items())} FROM b),
u AS ({" UNION ALL ".join(f"SELECT lang, source, '{r.name}' AS rate, {sketch_bin('q_' + r.name, '(CAST(1 AS BIGINT) << {})')} AS bin FROM m WHERE NOT q_base_failed" for r in RULES)}),
sketches AS (SELECT lang, source, rate, bin, count(*) AS n FROM u GROUP BY ALL),
fences AS ({threshold_sql("sketches", "//")})
SELECT doc_id, q_n_words AS n_words, q_word_chars AS word_chars, q_n_symbols AS n_symbols, q_n_dup_lines AS n_dup_lines, q_n_repeat_words AS n_repeat_words,
q_base_failed AS base_failed, coalesce(NOT q_base_failed AND {verdict()}, false) AS kept
FROM m LEFT JOIN fences f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source"""
