"""URL filters: explicit rules, and a character language-model ratio for the rest.

URLs that a rule decides are the examples. Two variable-order Markov models, one
of the accepted and one of the rejected URLs, give every character a probability
from up to three characters before it; an order without evidence hands over to
the next shorter one (Witten-Bell smoothing). The difference of the two
log-likelihoods per character, against a threshold calibrated on examples that
were held out, decides the URLs without a rule.

Everything is DataFrame and SQL functions. The model is a table over strings of
four symbols from an alphabet of 36, 1.7 million rows at most however many URLs
there are, so it can be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.llm.common import ASCII_LOWER, ASCII_UPPER, quoted, stored

ORDER = 4
SYMBOLS = 36  # a-z, 0 for all digits, / . _ - ~ %, * for all others, ^ and $
UNIT = 1_000_000  # log-likelihoods are whole millionths, so that sums do not depend on their order
BIN = 50_000
BINS = 40  # on either side of zero


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def symbols(text: Column) -> Column:
    """The text over the models' alphabet, with marks for start and end."""
    plain = F.translate(text, ASCII_UPPER + "123456789", ASCII_LOWER + "0" * 9)
    return F.concat(F.lit("^" * (ORDER - 1)), F.regexp_replace(plain, r"[^a-z0/._~%\-]", "*"), F.lit("$"))


def grams(marked: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(marked) - (ORDER - 1)), lambda i: F.substring(marked, i, ORDER))


def fit(counts: DataFrame) -> DataFrame:
    """Log-likelihood ratio of the last symbol of each gram: ``gram``, ``ratio``.

    ``counts`` has each gram with its number of accepted and rejected uses. Grams
    without any use get the probability their shorter contexts give.
    """
    model = None
    for order in range(1, ORDER + 1):
        level = counts.groupBy(F.substring("gram", ORDER - order + 1, order).alias("gram")).agg(
            F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        context = Window.partitionBy(F.substring("gram", 1, order - 1))
        for name in ("accepted", "rejected"):
            level = level.withColumns({
                f"{name}_all": F.sum(name).over(context),
                f"{name}_kinds": F.sum((F.col(name) > 0).cast("long")).over(context),
            })
        if model is None:
            level = level.withColumns({"p_accepted": F.lit(1.0 / SYMBOLS), "p_rejected": F.lit(1.0 / SYMBOLS)})
        else:
            shorter = model.select(F.col("gram").alias("shorter"), "p_accepted", "p_rejected")
            level = level.join(shorter, F.substring("gram", 2, order) == F.col("shorter"))
        model = level.select("gram", *[
            F.when(F.col(f"{name}_all") == 0, F.col(f"p_{name}")).otherwise(
                (F.col(name) + F.col(f"{name}_kinds") * F.col(f"p_{name}"))
                / (F.col(f"{name}_all") + F.col(f"{name}_kinds"))).alias(f"p_{name}")
            for name in ("accepted", "rejected")
        ])
    ratio = F.log("p_accepted") - F.log("p_rejected")
    return model.select("gram", F.floor(ratio * UNIT + 0.5).cast("long").alias("ratio"))


def calibrate(scored: DataFrame) -> int:
    """Threshold in millionths a symbol with the best balanced accuracy on held-out examples.

    One histogram of fixed size decides. Without held-out examples of both kinds
    the threshold is 0.
    """
    place = F.floor(F.col("total").cast("double") / F.col("n") / BIN).cast("long")
    rows = (
        scored.where("held_out and rule_verdict is not null")
        .groupBy(F.greatest(F.lit(-BINS), F.least(F.lit(BINS), place)).alias("bin"))
        .agg(F.sum((F.col("rule_verdict") == "allow").cast("long")).alias("good"),
             F.sum((F.col("rule_verdict") != "allow").cast("long")).alias("bad"))
        .collect()
    )
    good, bad = sum(r.good for r in rows), sum(r.bad for r in rows)
    if not good or not bad:
        return 0

    def worth(at: int) -> int:
        return bad * sum(r.good for r in rows if r.bin >= at) + good * sum(r.bad for r in rows if r.bin < at)

    return BIN * max(range(-BINS, BINS + 1), key=lambda at: (worth(at), -abs(at), -at))


def url_filter(pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, rule and verdict of every row of ``pages``.

    Repeated rows stay repeated. A null or malformed URL has an empty host and
    path, fits no rule and is judged by its empty text. An equal balance at the
    threshold allows. Other columns of ``pages`` are not read.
    """
    url = F.col("url")
    host, path = host_and_path(url)
    rows = pages.select(F.col(quoted(id_col)).alias("page_id"), F.col(quoted(url_col)).alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.select(
        "page_id", "host", "path",
        matching_rule(F.col("host"), F.col("path"), rules, lambda r: r.text).alias("rule"),
        matching_rule(F.col("host"), F.col("path"), rules, lambda r: r.verdict).alias("rule_verdict"),
        # by the text, so that copies are on one side
        F.substring(F.md5(F.concat("host", "path").cast("binary")), 1, 1).isin("0", "1", "2", "3").alias("held_out"),
        symbols(F.concat("host", "path")).alias("marked"),
    )
    example = ~F.col("held_out")
    counts = (
        rows.select(
            (example & (F.col("rule_verdict") == "allow")).cast("long").alias("accepted"),
            (example & (F.col("rule_verdict") == "block")).cast("long").alias("rejected"),
            F.explode(grams(F.col("marked"))).alias("gram"))
        .groupBy("gram")
        .agg(F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
             F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"))
    )
    model = stored(fit(counts), "url-model")
    length = F.length("marked") - (ORDER - 1)
    per_row = ["page_id", "host", "path", "rule", "rule_verdict", "held_out"]
    scored = (
        rows.select(*per_row, length.alias("n"), F.explode(grams(F.col("marked"))).alias("gram"))
        .join(F.broadcast(model), "gram")
        .groupBy(*per_row, "n")
        .agg(F.sum("ratio").alias("sum"), F.count("*").alias("uses"))
        # rows that are the same in all of this have been counted together
        .withColumn("copies", F.floor(F.col("uses") / F.col("n")).cast("int"))
        .select(*per_row, "n", F.expr("sum div copies").alias("total"), "copies")
    )
    scored = stored(scored, "url-scores")
    threshold = calibrate(scored.withColumn("n", F.col("n").cast("long")).select(
        "held_out", "rule_verdict", "n", "total", F.explode(F.sequence(F.lit(1), F.col("copies")))))
    judged = F.when(F.col("total") >= F.col("n") * threshold, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce(F.col("rule_verdict"), judged).alias("verdict"),
        (F.col("total") / F.col("n") / UNIT).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


ORACLE_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT rid, page_id,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ruled AS (
  SELECT *,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
         substr(md5(host || path), 1, 1) IN ('0', '1', '2', '3') AS held_out,
         '^^^' || regexp_replace(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
                                 '[^a-z0/._~%\-]', '*', 'g') || '$' AS marked
  FROM parts),
judged AS (
  SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS rule_verdict,
         length(marked) - 3 AS n
  FROM ruled),
uses AS (
  SELECT rid, held_out, rule_verdict, substr(marked, CAST(i AS BIGINT), 4) AS gram
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM judged)),
g4 AS (
  SELECT gram, coalesce(sum(CASE WHEN NOT held_out AND rule_verdict = 'allow' THEN 1 ELSE 0 END), 0) AS a,
         coalesce(sum(CASE WHEN NOT held_out AND rule_verdict = 'block' THEN 1 ELSE 0 END), 0) AS r
  FROM uses GROUP BY gram),
g3 AS (SELECT substr(gram, 2) AS gram, sum(a) AS a, sum(r) AS r FROM g4 GROUP BY 1),
g2 AS (SELECT substr(gram, 2) AS gram, sum(a) AS a, sum(r) AS r FROM g3 GROUP BY 1),
g1 AS (SELECT substr(gram, 2) AS gram, sum(a) AS a, sum(r) AS r FROM g2 GROUP BY 1),
p1 AS (
  SELECT gram, CASE WHEN an = 0 THEN 1.0::DOUBLE / 36 ELSE (a + ak * (1.0::DOUBLE / 36)) / (an + ak) END AS pa,
         CASE WHEN rn = 0 THEN 1.0::DOUBLE / 36 ELSE (r + rk * (1.0::DOUBLE / 36)) / (rn + rk) END AS pr
  FROM (SELECT *, sum(a) OVER () AS an, sum(r) OVER () AS rn, sum((a > 0)::INT) OVER () AS ak, sum((r > 0)::INT) OVER () AS rk FROM g1)),
p2 AS (
  SELECT x.gram, CASE WHEN an = 0 THEN pa ELSE (a + ak * pa) / (an + ak) END AS pa, CASE WHEN rn = 0 THEN pr ELSE (r + rk * pr) / (rn + rk) END AS pr
  FROM (SELECT *, sum(a) OVER w AS an, sum(r) OVER w AS rn, sum((a > 0)::INT) OVER w AS ak, sum((r > 0)::INT) OVER w AS rk
        FROM g2 WINDOW w AS (PARTITION BY substr(gram, 1, 1))) x JOIN p1 ON p1.gram = substr(x.gram, 2)),
p3 AS (
  SELECT x.gram, CASE WHEN an = 0 THEN pa ELSE (a + ak * pa) / (an + ak) END AS pa, CASE WHEN rn = 0 THEN pr ELSE (r + rk * pr) / (rn + rk) END AS pr
  FROM (SELECT *, sum(a) OVER w AS an, sum(r) OVER w AS rn, sum((a > 0)::INT) OVER w AS ak, sum((r > 0)::INT) OVER w AS rk
        FROM g3 WINDOW w AS (PARTITION BY substr(gram, 1, 2))) x JOIN p2 ON p2.gram = substr(x.gram, 2)),
p4 AS (
  SELECT x.gram, CASE WHEN an = 0 THEN pa ELSE (a + ak * pa) / (an + ak) END AS pa, CASE WHEN rn = 0 THEN pr ELSE (r + rk * pr) / (rn + rk) END AS pr
  FROM (SELECT *, sum(a) OVER w AS an, sum(r) OVER w AS rn, sum((a > 0)::INT) OVER w AS ak, sum((r > 0)::INT) OVER w AS rk
        FROM g4 WINDOW w AS (PARTITION BY substr(gram, 1, 3))) x JOIN p3 ON p3.gram = substr(x.gram, 2)),
model AS (SELECT gram, CAST(floor((ln(pa) - ln(pr)) * 1000000 + 0.5) AS BIGINT) AS ratio FROM p4),
totals AS (SELECT rid, CAST(sum(ratio) AS BIGINT) AS total FROM uses JOIN model USING (gram) GROUP BY rid),
scored AS (SELECT j.*, t.total FROM judged j JOIN totals t USING (rid)),
bins AS (
  SELECT greatest(-40, least(40, CAST(floor(CAST(total AS DOUBLE) / n / 50000) AS BIGINT))) AS bin,
         sum((rule_verdict = 'allow')::INT) AS good, sum((rule_verdict <> 'allow')::INT) AS bad
  FROM scored WHERE held_out AND rule_verdict IS NOT NULL GROUP BY 1),
steps AS (
  SELECT t.edge, (SELECT sum(bad) FROM bins) * coalesce((SELECT sum(good) FROM bins WHERE bin >= t.edge), 0)
             + (SELECT sum(good) FROM bins) * coalesce((SELECT sum(bad) FROM bins WHERE bin < t.edge), 0) AS worth
  FROM (SELECT unnest(range(-40, 41)) AS edge) t),
chosen AS (
  SELECT CASE WHEN (SELECT sum(good) FROM bins) > 0 AND (SELECT sum(bad) FROM bins) > 0
              THEN (SELECT edge * 50000 FROM steps ORDER BY worth DESC, abs(edge), edge LIMIT 1) ELSE 0 END AS threshold)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN total >= n * threshold THEN 'allow' ELSE 'block' END) AS verdict,
       CAST(total AS DOUBLE) / n / 1000000 AS score
FROM scored, chosen
"""
