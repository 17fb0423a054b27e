"""URL filter: rules first, then a character language-model ratio.

Two smoothed variable-order Markov models, one for accepted and one for
rejected URLs, are estimated from the URLs the rules decide.  A character's
probability after its last three characters is interpolated down the orders,
``p_k = (n(h c) + L p_{k-1}) / (n(h) + L)``, with a uniform base.  A URL's score
is the sum of log p_accepted - log p_rejected over its characters (host, path
and an end mark) divided by their number; the threshold that separates the
rule-decided URLs with the fewest errors accepts the rest.

Everything is DataFrame expressions.  The log ratio is worked out once per
distinct four-character window (a table bounded by the alphabet, not by the
data), rounded to millionths and summed as integers, so the sums do not depend
on the order of rows.

Defined results: a null url, or one without ``://``, has an empty host and path
and is scored on the end mark alone; repeated rows and equal ids each keep
their row; with no rule-decided URLs every score is 0 and the verdict is
allow; an empty table gives no rows; columns besides id and url play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import pin, pins, shuffle_partitions

#: The rules: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 3
SMOOTHING = 1.0
ALPHABET = 256
SCALE = 1_000_000
BINS_PER_NAT = 1000
#: The window table is broadcast up to this many rows (about 100 bytes each), else joined by shuffle.
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_rules(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``ruled`` (its verdict); the longest fitting rule wins."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    out = pages.withColumn("host", F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER))
    out = out.withColumn("path", F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, ruled = F.when(fits, host + path).otherwise(rule), F.when(fits, verdict).otherwise(ruled)
    return out.withColumn("rule", rule).withColumn("ruled", ruled)


def _windows(df: DataFrame) -> DataFrame:
    """One row per character of ``s``: the character after its ORDER predecessors."""
    return (df.withColumn("ch", F.concat(F.array(*[F.lit("\x02")] * ORDER), F.filter(F.split("s", ""), lambda x: x != ""), F.array(F.lit("\x03"))))
            .withColumn("g", F.explode(F.expr("transform(sequence(0, size(ch) - 4), i -> concat(ch[i], ch[i+1], ch[i+2], ch[i+3]))")))
            .drop("ch"))


def window_ratios(windows: DataFrame) -> DataFrame:
    """(g, ratio): scaled log ratio of the last character of each window ``g``,
    from columns g, a, r (occurrences in accepted and rejected URLs)."""
    model = None
    for k in range(ORDER + 1):
        level = windows.groupBy(F.substring("g", ORDER + 1 - k, k + 1).alias("g")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = level.groupBy(F.substring("g", 1, k).alias("h")).agg(F.sum("a").alias("ha"), F.sum("r").alias("hr"))
        level = level.join(context, F.substring("g", 1, k) == F.col("h"))
        if model is None:
            pa = pr = F.lit(1.0 / ALPHABET)
        else:
            lower = model.select(F.col("g").alias("low"), F.col("pa").alias("la"), F.col("pr").alias("lr"))
            level = level.join(lower, F.substring("g", 2, k) == F.col("low"))
            pa, pr = F.col("la"), F.col("lr")
        model = level.select("g", ((F.col("a") + SMOOTHING * pa) / (F.col("ha") + SMOOTHING)).alias("pa"),
                             ((F.col("r") + SMOOTHING * pr) / (F.col("hr") + SMOOTHING)).alias("pr"))
    return model.select("g", F.round((F.log("pa") - F.log("pr")) * SCALE).cast("long").alias("ratio"))


def calibrate(scored: DataFrame) -> int:
    """The bin from which scores are accepted: fewest errors on rule-decided rows, lowest on ties.

    ``scored``: bin, a, r.  One row per 1/1000 nat comes to the window, whatever the data.
    """
    bins = scored.groupBy("bin").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    errors = bins.select("bin", (F.coalesce(F.sum("a").over(below), F.lit(0)) + F.sum("r").over(total)
                                 - F.coalesce(F.sum("r").over(below), F.lit(0))).alias("e"), F.sum(F.col("a") + F.col("r")).over(total).alias("n"))
    row = errors.filter("n > 0").orderBy("e", "bin").limit(1).collect()
    return row[0]["bin"] if row else 0


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, score) for every page."""
    ruled = with_rules(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), "url", rules).drop("url")
    ruled = ruled.withColumn("s", F.concat("host", "path"))
    with pins() as own:
        # few bytes, but each is taken apart into many windows: over all tasks, not the one that the bytes would fill
        texts = pin(ruled.groupBy("s", "ruled").agg(F.count(F.lit(1)).alias("n")).repartition(shuffle_partitions(pages.sparkSession)))
        texts = texts.select("s", F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0).alias("a"),
                             F.when(F.col("ruled") == "block", F.col("n")).otherwise(0).alias("r"))
        grams = pin(_windows(texts).groupBy("g").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
        ratios = pin(window_ratios(grams))
        if ratios.count() <= BROADCAST_ROWS:
            ratios = F.broadcast(ratios)
        scores = pin(_windows(texts).join(ratios, "g").groupBy("s").agg(
            F.sum("ratio").alias("total"), F.count(F.lit(1)).alias("length"), F.first("a").alias("a"), F.first("r").alias("r"))
            .withColumn("bin", F.floor(F.col("total") * BINS_PER_NAT / (F.col("length") * SCALE))))
        cut = calibrate(own.keep(scores))
    return (ruled.join(scores.select(F.col("s").alias("s2"), "total", "length", "bin"), F.col("s") == F.col("s2"), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("bin") >= cut, "allow").otherwise("block")).alias("verdict"),
                    F.round(F.col("total") / (F.col("length") * SCALE), 6).alias("score")))


def oracle() -> str:
    """DuckDB SQL of ``filter_urls`` over the table pages (without the score)."""
    longest = sorted(RULES, key=lambda r: -len(r[1]) - len(r[2]))
    fits = [(f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')", v, h + p) for v, h, p in longest]
    case = lambda i: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[i]}'" for f in fits) + " END"
    ctes = []
    for k in range(ORDER + 1):
        lower = "" if k == 0 else f" JOIN m{k - 1} lo ON lo.g = substring(l.g, 2, {k})"
        pa, pr = (f"{1.0 / ALPHABET}::DOUBLE",) * 2 if k == 0 else ("lo.pa", "lo.pr")
        ctes.append(f"""l{k} AS (SELECT substring(g, {ORDER + 1 - k}, {k + 1}) AS g, sum(a)::DOUBLE AS a, sum(r)::DOUBLE AS r FROM grams GROUP BY 1),
c{k} AS (SELECT substring(g, 1, {k}) AS h, sum(a) AS ha, sum(r) AS hr FROM l{k} GROUP BY 1),
m{k} AS (SELECT l.g, (l.a + {SMOOTHING}::DOUBLE * {pa}) / (c.ha + {SMOOTHING}::DOUBLE) AS pa,
  (l.r + {SMOOTHING}::DOUBLE * {pr}) / (c.hr + {SMOOTHING}::DOUBLE) AS pr
  FROM l{k} l JOIN c{k} c ON c.h = substring(l.g, 1, {k}){lower})""")
    return f"""WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (SELECT *, host || path AS s, {case(2)} AS rule, {case(1)} AS ruled FROM parts),
texts AS (SELECT s, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS r,
  repeat(chr(2), {ORDER}) || s || chr(3) AS padded FROM ruled GROUP BY s),
pos AS (SELECT s, a, r, padded, unnest(range(1, length(s)::BIGINT + 2)) AS i FROM texts),
wins AS (SELECT s, a, r, substring(padded, i, {ORDER + 1}) AS g FROM pos),
grams AS (SELECT g, sum(a) AS a, sum(r) AS r FROM wins GROUP BY g),
{', '.join(ctes)},
ratios AS (SELECT g, round((ln(pa) - ln(pr)) * {SCALE})::BIGINT AS ratio FROM m{ORDER}),
scores AS (SELECT s, any_value(a) AS a, any_value(r) AS r,
  floor(sum(ratio)::DOUBLE * {BINS_PER_NAT} / (count(*) * {SCALE}))::BIGINT AS bin FROM wins JOIN ratios USING (g) GROUP BY s),
bins AS (SELECT bin, sum(a) AS a, sum(r) AS r FROM scores GROUP BY bin),
errors AS (SELECT bin, coalesce(sum(a) OVER w, 0) + sum(r) OVER () - coalesce(sum(r) OVER w, 0) AS e FROM bins
  WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT coalesce((SELECT CASE WHEN (SELECT sum(a + r) FROM bins) > 0 THEN bin END FROM errors ORDER BY e, bin LIMIT 1), 0) AS c)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN bin >= (SELECT c FROM cut) THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled JOIN scores USING (s)"""
