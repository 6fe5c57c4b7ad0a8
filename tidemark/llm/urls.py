"""URL filter: allow and block rules, and a ratio of two character language models for the rest.

Model. URLs that a rule allows are accepted examples, those it blocks are rejected ones. For each side a
variable-order Markov model over code points is counted: for contexts of 0 to `order` characters,
p(c | context) = (n(context, c) + weight * p(c | shorter context)) / (n(context) + weight), down to a
uniform 1 / (V + 1). A context never seen hands its whole mass to the shorter one, so the order varies
with the data. The score of a URL is the mean over its characters and its end of
ln p_accepted - ln p_rejected.

Calibration. A fifth of the distinct example URLs is left out of the counts. Their scores, in bins of
0.01, choose the threshold: the middle of the lowest gap between bins that gives the largest share of accepted
URLs above it plus share of rejected URLs below it. Without such examples of both sides the threshold is 0.

Cases. Null or empty URLs, and those without `://`, have an empty host and path, fit no rule and are
judged by the model (an empty text has only its end). Repeated rows are judged alike, each on its own row.
Without any example every unruled URL is allowed. Other columns of the input are not read. An empty table gives
no rows.

Plan. Distinct URLs are scored once. Characters are exploded with their context of `order` characters and
counted with map-side combine; lower orders are sums over that table. Each distinct window gets its
difference once, in integer millionths, and is joined to the URLs' windows, which carry the number of their URL in
place of its text; frequent windows are split by adaptive skew joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import LOWER, UPPER, load, lower_ascii, saved

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
ORDER, WEIGHT, PARTS, LIMIT = 4, 2.0, 5, 2000
START, END = "\x02", "\x03"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def fitting(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct<rule, verdict>; null if none does."""
    tests = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        tests.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("struct<rule:string,verdict:string>")


def side(url: Column) -> Column:
    """A number of the URL that chooses its fold."""
    return F.conv(F.substring(F.md5(url), 1, 6), 16, 10).cast("bigint") % PARTS


def letters_of(url: Column, order: int) -> Column:
    """The code points of a URL, with marks of start and end."""
    return F.regexp_extract_all(F.concat(F.lit(START * order), url, F.lit(END)), F.lit("(?s)."), F.lit(0))


def windows(letters: Column, order: int) -> Column:
    """Every character and the end, each behind the `order` characters before it."""
    return F.transform(
        F.sequence(F.lit(1), F.size(letters) - order),
        lambda i: F.array_join(F.slice(letters, i, order + 1), ""),
    )


def differences(counts: DataFrame, seen: DataFrame, order: int, weight: float) -> DataFrame:
    """ln p_accepted - ln p_rejected in millionths for each `gram` of `seen`.

    counts: gram, a, r, the times that accepted and rejected examples hold it.
    """
    size = F.length("gram")
    letters = counts.where("a + r > 0").select(F.substring("gram", -1, 1).alias("c")).distinct().count()  # one number
    out = seen.select("gram", *[F.lit(1.0 / (letters + 1)).alias(p) for p in ("pa", "pr")])
    for n in range(order + 1):
        own = F.substr("gram", size - n)
        before = F.substr("gram", size - n, F.lit(n))
        of_gram = counts.groupBy(own.alias("own")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        of_context = counts.groupBy(before.alias("before")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"))
        zero = {"a": 0, "r": 0, "na": 0, "nr": 0}
        out = (
            out.withColumns({"own": own, "before": before})
            .join(of_gram, "own", "left").join(of_context, "before", "left").fillna(zero)
            .select(
                "gram",
                ((F.col("a") + weight * F.col("pa")) / (F.col("na") + weight)).alias("pa"),
                ((F.col("r") + weight * F.col("pr")) / (F.col("nr") + weight)).alias("pr"),
            )
        )
    return out.select("gram", F.round((F.ln("pa") - F.ln("pr")) * 1e6).cast("bigint").alias("difference"))


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    order: int = ORDER,
    weight: float = WEIGHT,
) -> DataFrame:
    """id, host, path, rule, verdict and score (mean difference, null for an empty table) of every row."""
    rows = pages.select(F.col(id_column), F.col(url_column).alias("_url"))
    host, path = parts(F.col("url"))
    known = saved(
        rows.groupBy(F.coalesce("_url", F.lit("")).alias("url")).agg(F.count("*").alias("n"))
        .withColumns({"host": host, "path": path})
        .withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
        .withColumn("letters", letters_of(F.col("url"), order))  # once: a window takes a slice of it
        .withColumn("place", F.monotonically_increasing_id())  # as written: short in the windows' exchanges
    )
    verdict, held = F.col("fit.verdict"), side(F.col("url")) == 0
    grams = known.select(
        "place", "n", verdict.alias("verdict"), held.alias("held"), F.explode(windows(F.col("letters"), order)).alias("gram")
    )

    def times(name: str) -> Column:
        return F.sum(F.when((F.col("verdict") == name) & ~F.col("held"), F.col("n")).otherwise(0))

    counts = saved(grams.groupBy("gram").agg(times("allow").alias("a"), times("block").alias("r")))
    model = saved(differences(counts.where("a + r > 0"), counts.select("gram"), order, weight))
    scores = saved(
        grams.select("place", "gram").join(model, "gram").groupBy("place")
        .agg((F.sum("difference") / F.count("*")).alias("mean"))
        .join(known.drop("letters"), "place")
        .withColumn("bin", F.floor(F.col("mean") / 10000.0).cast("bigint"))
    )
    limit = threshold(scores.where(held))
    told = F.coalesce(verdict, F.when(F.col("bin") >= limit, "allow").otherwise("block"))
    answers = scores.select(
        F.col("url").alias("_url"), "host", "path", F.col("fit.rule").alias("rule"), told.alias("verdict"),
        (F.col("mean") / 1e6).alias("score"),
    )
    return rows.withColumn("_url", F.coalesce("_url", F.lit(""))).join(answers, "_url").drop("_url")


def threshold(examples: DataFrame) -> int:
    """The middle of the lowest gap between bins with the most accepted examples above it plus rejected ones below, as shares."""
    edge = F.greatest(F.least(F.col("bin"), F.lit(LIMIT)), F.lit(-LIMIT))
    rows = examples.groupBy(edge.alias("bin")).agg(
        F.sum(F.when(F.col("fit.verdict") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("fit.verdict") == "block", F.col("n")).otherwise(0)).alias("r"),
    ).orderBy("bin").collect()  # at most 2 * LIMIT + 1 rows
    all_a, all_r = sum(row.a for row in rows), sum(row.r for row in rows)
    if not all_a or not all_r:
        return 0
    best, limit, below_a, below_r, last = -1, 0, 0, 0, None
    for row in rows:
        gain = (all_a - below_a) * all_r + below_r * all_a
        if gain > best:
            best, limit = gain, row.bin if last is None else (last + row.bin + 1) // 2
        below_a, below_r, last = below_a + row.a, below_r + row.r, row.bin
    return limit


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judged(load(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    fits = " ".join(
        f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{verdict} {rule}'"
        for verdict, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
        for name, slash, rest in [rule.partition("/")]
    )
    levels, last = [], "p0"
    for n in range(ORDER + 1):
        own, before = f"right(gram, {n + 1})", f"left(right(gram, {n + 1}), {n})"
        levels.append(
            f"g{n} AS (SELECT {own} AS own, sum(a) AS a, sum(r) AS r FROM counts GROUP BY 1), "
            f"c{n} AS (SELECT {before} AS before, sum(a) AS na, sum(r) AS nr FROM counts GROUP BY 1), "
            f"p{n + 1} AS (SELECT gram, (coalesce(a, 0)::DOUBLE + {WEIGHT}::DOUBLE * pa) / (coalesce(na, 0)::DOUBLE + {WEIGHT}::DOUBLE) AS pa, "
            f"(coalesce(r, 0)::DOUBLE + {WEIGHT}::DOUBLE * pr) / (coalesce(nr, 0)::DOUBLE + {WEIGHT}::DOUBLE) AS pr "
            f"FROM {last} LEFT JOIN g{n} ON g{n}.own = {own} LEFT JOIN c{n} ON c{n}.before = {before})"
        )
        last = f"p{n + 1}"
    return f"""
WITH cut AS (
  SELECT coalesce(url, '') AS url, count(*) AS n,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages GROUP BY ALL),
split AS (
  SELECT url, n, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
known AS (
  SELECT *, CASE {fits} END AS fit,
         ('0x' || substr(md5(url), 1, 6))::BIGINT % {PARTS} = 0 AS held FROM split),
padded AS (
  SELECT url, n, held, left(fit, 5) AS verdict, repeat(chr(2), {ORDER}) || url || chr(3) AS t, length(url) AS size FROM known),
grams AS (
  SELECT url, n, held, verdict, substr(t, i, {ORDER + 1}) AS gram
  FROM (SELECT *, unnest(generate_series(1, size + 1)) AS i FROM padded)),
tally AS (
  SELECT gram, sum(CASE WHEN verdict = 'allow' AND NOT held THEN n ELSE 0 END) AS a,
         sum(CASE WHEN verdict = 'block' AND NOT held THEN n ELSE 0 END) AS r FROM grams GROUP BY 1),
counts AS (SELECT * FROM tally WHERE a + r > 0),
p0 AS (
  SELECT gram, 1::DOUBLE / (v + 1) AS pa, 1::DOUBLE / (v + 1) AS pr
  FROM tally, (SELECT count(DISTINCT right(gram, 1)) AS v FROM counts)),
{", ".join(levels)},
model AS (SELECT gram, round((ln(pa) - ln(pr)) * 1e6)::BIGINT AS difference FROM {last}),
scores AS (
  SELECT url, floor(sum(difference)::DOUBLE / count(*) / 10000)::BIGINT AS bin
  FROM grams JOIN model USING (gram) GROUP BY 1),
bins AS (
  SELECT greatest(least(bin, {LIMIT}), -{LIMIT}) AS bin, sum(CASE WHEN left(fit, 5) = 'allow' THEN n ELSE 0 END) AS a,
         sum(CASE WHEN left(fit, 5) = 'block' THEN n ELSE 0 END) AS r
  FROM scores JOIN known USING (url) WHERE held GROUP BY 1),
edges AS (
  SELECT coalesce(floor((lag(bin) OVER (ORDER BY bin) + bin + 1) / 2.0)::BIGINT, bin) AS bin, sum(a) OVER () AS all_a, sum(r) OVER () AS all_r,
         coalesce(sum(a) OVER before, 0) AS below_a, coalesce(sum(r) OVER before, 0) AS below_r
  FROM bins WINDOW before AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
edge AS (
  SELECT coalesce((SELECT bin FROM edges WHERE all_a > 0 AND all_r > 0
                   ORDER BY (all_a - below_a) * all_r + below_r * all_a DESC, bin LIMIT 1), 0) AS lowest)
SELECT page_id, host, path, nullif(substr(fit, 7), '') AS rule,
       CASE WHEN fit IS NOT NULL THEN left(fit, 5) WHEN bin >= lowest THEN 'allow' ELSE 'block' END AS verdict
FROM pages JOIN known ON known.url = coalesce(pages.url, '') JOIN scores ON scores.url = known.url, edge
"""


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLE_SQL = {"op1_url_filter": _sql()}
