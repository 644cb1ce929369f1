"""Line dedup: windows of three consecutive lines that occurred before are removed.

Lines with a visible character are trimmed and hashed; three consecutive ones
form a window, overlapping. A window that occurs more than once in the corpus
stays at its first place (smallest doc_id, then position) and is removed at all
later ones: the lines that its later occurrences cover are merged and cut.

Everything is DataFrame and SQL functions. Occurrences are counted with map-side
aggregation, so a window that a third of all documents contain costs one row a
task; the join back moves the occurrences by a key that adaptive execution can
split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.llm.common import merge_join, quoted, stored

BLANKS = r" \t\r\u000B\f"
ROOM = 2_147_483_648  # more than the lines of any text

# lines with a visible character: place among all lines, two hashes with own seeds
LINES = f"""transform(
    filter(transform(split(text, '\\n', -1), (l, i) -> struct(i AS place, btrim(l, '{BLANKS}') AS line)), x -> x.line <> ''),
    x -> struct(x.place AS place, xxhash64(x.line) AS a, xxhash64(1, x.line) AS b))"""
WINDOWS = """transform(sequence(0, size(lines) - 3), j -> struct(
    j AS start,
    xxhash64(lines[j].a, lines[j + 1].a, lines[j + 2].a) AS a,
    xxhash64(lines[j].b, lines[j + 1].b, lines[j + 2].b) AS b))"""
# places left, from all places less those that the windows at `starts` cover
LEFT = """array_except(sequence(0, size(split(text, '\\n', -1)) - 1),
    flatten(transform(starts, s -> array(lines[s].place, lines[s + 1].place, lines[s + 2].place))))"""


def windows(rows: DataFrame) -> DataFrame:
    """One row for each window of each text: ``doc_id``, ``text_hash``, ``start``, ``a``, ``b``, ``rank``."""
    return (
        rows.where("doc_id is not null")
        .select("doc_id", "text_hash", F.expr(LINES).alias("lines"))
        .where("size(lines) >= 3")
        .select("doc_id", "text_hash", F.expr(f"inline({WINDOWS})"))
        .withColumn("rank", F.expr(f"cast(doc_id AS decimal(20, 0)) * {ROOM} + start"))
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines cut from its text, and ``n_lines`` and ``n_removed``.

    Kept lines are unchanged, blank lines included. Texts with fewer than three
    visible lines have no window. Rows with a null text or doc_id stay as they
    are. Rows with the same doc_id are compared by position, and equal positions
    both stay, so repeated rows are treated alike. ``n_lines`` counts all lines (0
    for null). Input columns of the names ``n_lines`` and ``n_removed`` are
    replaced. An empty table gives an empty result.
    """
    rows = docs.select(
        # the text once, beside the other columns
        F.struct(*[F.col(quoted(c)) for c in docs.columns if c != text_col]).alias("row"), F.col(quoted(id_col)).cast("long").alias("doc_id"),
        F.col(quoted(text_col)).alias("text"), F.xxhash64(F.col(quoted(text_col))).alias("text_hash"))
    found = windows(rows)
    repeated = stored(
        found.groupBy("a", "b").agg(F.min("rank").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "repeated-windows")
    later = (
        merge_join(found, repeated, ["a", "b"]).where("rank > first")
        .groupBy("doc_id", "text_hash").agg(F.collect_set("start").alias("starts"))
    )
    later = stored(later, "covered-lines").withColumnsRenamed({"doc_id": "at_doc", "text_hash": "at_text"})
    joined = merge_join(rows, later, (F.col("doc_id") == F.col("at_doc")) & (F.col("text_hash") == F.col("at_text")), "left")
    # lines are hashed again only where something is cut
    joined = joined.select("row", "text", "starts", F.expr(f"CASE WHEN starts IS NOT NULL THEN {LINES} END").alias("lines"))
    joined = joined.select("row", "text", F.expr(f"CASE WHEN starts IS NOT NULL THEN {LEFT} END").alias("left"))
    kept = F.expr(
        "CASE WHEN left IS NULL THEN text ELSE "
        "array_join(transform(array(split(text, '\\n', -1)), l -> array_join(transform(left, i -> l[i]), '\\n')), '') END")
    # through a generator, so that a filter on the result is not moved below it and computes all this again
    joined = joined.select("row", F.inline(F.array(F.struct(
        kept.alias("text"),
        F.expr("coalesce(size(split(text, '\\n', -1)), 0)").alias("n_lines"),
        F.expr("CASE WHEN left IS NULL THEN 0 ELSE size(split(text, '\\n', -1)) - size(left) END").alias("n_removed")))))
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    columns = [F.col("text").alias(c) if c == text_col else F.col(f"row.{quoted(c)}").alias(c) for c in own]
    return joined.select(
        *columns, F.greatest(F.col("n_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"))


ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
all_lines AS (
  SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM docs),
visible AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY place) AS start
  FROM (SELECT rid, doc_id, place, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM all_lines)
  WHERE line <> ''),
spans AS (
  SELECT rid, doc_id, start, place, lead(place, 1) OVER w AS place2, lead(place, 2) OVER w AS place3,
         line, lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3
  FROM visible WINDOW w AS (PARTITION BY rid ORDER BY start)),
firsts AS (
  SELECT *, rank() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, start) AS nth
  FROM spans WHERE line3 IS NOT NULL AND doc_id IS NOT NULL),
cut AS (
  SELECT rid, place FROM firsts WHERE nth > 1
  UNION SELECT rid, place2 FROM firsts WHERE nth > 1
  UNION SELECT rid, place3 FROM firsts WHERE nth > 1),
kept AS (
  SELECT l.rid, string_agg(l.line, chr(10) ORDER BY l.place) AS text, count(*) AS n
  FROM all_lines l ANTI JOIN cut USING (rid, place) GROUP BY l.rid)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed
FROM docs d LEFT JOIN kept k USING (rid)
"""
