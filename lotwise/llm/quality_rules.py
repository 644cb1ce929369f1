"""Quality rules: a table of thresholds compiled into one projection.

Every rule compares a whole number ``value`` with a share of another, ``value <=
share * of``. All measures come from Spark SQL functions over the words and lines
of the whole text; there is no user function and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.common import ascii_lower, quoted

SPACES = r"[\x20\x09-\x0D]+"
SPACES_SQL = SPACES.replace("\\", "\\\\")  # inside a SQL string literal
WINDOW = 5
STOP_WORDS = tuple(
    "a an and are as at be by for from in is it of on or that the this to was were with you "
    "der die das und ist in den von zu mit sich des auf für im dem nicht ein eine als auch es an "
    "el la los las de del que y en un una por con no para es se al lo como "
    "le les des et à du il au aux ne pas pour par sur dans qui sont ce".split())


@dataclass(frozen=True)
class Rule:
    """Fails a text if ``value`` is outside ``low``..``high`` per ``of`` (1: an absolute bound)."""

    name: str
    value: str
    of: str = "1"
    low: float | None = None
    high: float | None = None
    at_least_words: int = 0


BASE = (
    Rule("too_short", "n_words", low=10),
    Rule("repetitive", "n_repeat_words", of="n_words", high=0.2),
)
RULES = (
    Rule("word_length", "word_chars", of="n_words", low=2, high=20),
    Rule("symbols", "n_symbols", of="n_words", high=0.1),
    Rule("no_letters", "n_letter_words", of="n_words", low=0.6),
    Rule("stop_words", "n_stop_words", of="n_words", low=0.02, at_least_words=50),
    Rule("bullets", "n_bullet_lines", of="n_lines", high=0.9),
    Rule("ellipses", "n_ellipsis_lines", of="n_lines", high=0.3),
    Rule("repeated_lines", "n_dup_lines", of="n_lines", high=0.5),
    Rule("shouting", "n_shout_words", of="n_words", high=0.5, at_least_words=10),
)

_GRAMS = f"transform(sequence(0, size(words) - {WINDOW}), i -> concat_ws(' ', slice(words, i + 1, {WINDOW})))"
# For texts with a repeated window: sorted windows show which places repeat, and
# each place covers its words up to the next one. array(x) with transform binds x,
# so that it is computed once.
_PLACES = """element_at(transform(array(array_sort(transform(g, (x, i) -> struct(x AS x, i AS i)))),
    s -> array_sort(filter(transform(s, (e, j) -> IF((j > 0 AND s[j - 1].x = e.x) OR (j + 1 < size(s) AND s[j + 1].x = e.x), e.i, -1)),
                           p -> p >= 0))), 1)"""
_COVERED = f"""element_at(transform(array({_PLACES}),
    p -> aggregate(transform(p, (a, j) -> IF(j + 1 < size(p), least({WINDOW}, p[j + 1] - a), {WINDOW})), 0, (x, y) -> x + y)), 1)"""
REPEATED = f"""CASE WHEN size(words) < {WINDOW} THEN 0
    ELSE element_at(transform(array({_GRAMS}), g -> IF(size(array_distinct(g)) = size(g), 0, {_COVERED})), 1) END"""


def _count(array: str, condition: str) -> str:
    return f"size(filter({array}, x -> {condition}))"


def measures(rows: DataFrame) -> DataFrame:
    """``rows`` (key, text) with all counts; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.withColumn("text", text).select(
        "key", "text",
        F.expr(rf"filter(split(text, '{SPACES_SQL}'), w -> w <> '')").alias("words"),
        F.expr(rf"filter(split(text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
        F.filter(F.split(ascii_lower(F.col("text")), r"[^\p{L}]+"), lambda w: w != "").alias("letters"))
    counts = F.struct(
        F.expr("size(words)").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).alias("n_symbols"),
        F.expr("size(lines) - size(array_distinct(lines))").alias("n_dup_lines"),
        F.expr(REPEATED).alias("n_repeat_words"),
        F.expr("size(lines)").alias("n_lines"),
        F.size("letters").alias("n_letter_words"),
        F.size(F.filter("letters", lambda w: w.isin(*dict.fromkeys(STOP_WORDS)))).alias("n_stop_words"),
        F.expr(_count("words", "length(x) > 1 AND upper(x) = x AND lower(x) <> x")).alias("n_shout_words"),
        F.expr(_count("lines", r"x rlike '^[\\x20\\x09-\\x0D]*[-*•]'")).alias("n_bullet_lines"),
        F.expr(_count("lines", r"x rlike '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'")).alias("n_ellipsis_lines"),
    )
    # through a generator, so that a filter on the result is not moved below it and splits the text again for every count
    return rows.select("key", F.inline(F.array(counts)))


def fails(rule: Rule) -> Column:
    """The rule as a column, in whole thousandths so that no rounding decides."""
    value, of = F.col(rule.value).cast("long") * 1000, F.lit(1) if rule.of == "1" else F.col(rule.of).cast("long")
    failed = F.lit(False)
    if rule.low is not None:
        failed = failed | (value < of * round(rule.low * 1000))
    if rule.high is not None:
        failed = failed | (value > of * round(rule.high * 1000))
    return failed & (F.col("n_words") >= rule.at_least_words)


def any_of(rules: Sequence[Rule]) -> Column:
    failed = F.lit(False)
    for rule in rules:
        failed = failed | fails(rule)
    return failed


def quality_rules(docs: DataFrame, base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its measures, ``base_failed``, ``failed_rules`` and ``kept``.

    Words are runs without ASCII white space. A null text has no words and fails
    as too short. Repeated rows each get the same answer; a null doc_id is kept as
    null; other columns are not read.
    """
    rows = measures(docs.select(F.col(quoted(id_col)).alias("key"), F.col(quoted(text_col)).alias("text")))
    names = F.array_compact(F.array(*[F.when(fails(r), F.lit(r.name)) for r in (*base, *rules)]))
    longs = [F.col(c).cast("long").alias(c) for c in rows.columns if c != "key"]
    return rows.select(
        F.col("key").alias("doc_id"), *longs, any_of(base).alias("base_failed"),
        (~any_of((*base, *rules))).alias("kept"), names.alias("failed_rules"))


def oracle_sql() -> str:
    """The counts and both verdicts in SQL."""
    stop = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))

    def condition(rule: Rule) -> str:
        parts = []
        if rule.low is not None:
            parts.append(f"{rule.value} * 1000 < {rule.of} * {round(rule.low * 1000)}")
        if rule.high is not None:
            parts.append(f"{rule.value} * 1000 > {rule.of} * {round(rule.high * 1000)}")
        return f"(({' OR '.join(parts)}) AND n_words >= {rule.at_least_words})"

    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
         string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\pL]+') AS letters
  FROM docs),
grams AS (
  SELECT rid, i, list_aggregate(list_slice(words, i, i + 4), 'string_agg', ' ') AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
repeats AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM repeats) GROUP BY rid),
counted AS (
  SELECT s.rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(letters, lambda x: x <> '')) AS BIGINT) AS n_letter_words,
         CAST(len(list_filter(letters, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop_words,
         CAST(len(list_filter(words, lambda x: regexp_matches(x, '^[^\p{{Ll}}]*\p{{Lu}}[^\p{{Ll}}]*$') AND length(x) > 1)) AS BIGINT) AS n_shout_words,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*' || chr(8226) || ']'))) AS BIGINT) AS n_bullet_lines,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|' || chr(8230) || ')[\x20\x09-\x0D]*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM split s LEFT JOIN covered c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_letter_words, n_stop_words,
       n_shout_words, n_bullet_lines, n_ellipsis_lines,
       {' OR '.join(map(condition, BASE))} AS base_failed,
       NOT ({' OR '.join(map(condition, (*BASE, *RULES)))}) AS kept
FROM counted
"""
