"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Four statistics of each text are transformed so that clean text is near normal. For each language and source, each
language, and all rows, concentration steps look for the ``SUPPORT`` share of rows whose covariance has the least
determinant: from three starts (scaled medians, covariance of damped values, covariance of directions) each step takes
the rows nearest by the last estimate, until the determinant stands still; the start that ends lowest wins. A group's
estimate is then shrunk to its language's, and that to everybody's, by the share PRIOR / (rows + PRIOR), at every size
alike. A row is rejected if its Mahalanobis distance is beyond the chi-square quantile. DataFrame functions only.

A step is one aggregation: rows are summed up by group, start and bin of their squared distance (count, first and second
moments), and a running count over a group's bins gives the nearest rows. Bins follow the logarithm of the distance, so
a group has some hundreds at most, whatever its rows; a group of any size is pre-aggregated where its rows are.

Cases: a null text has no words, fails the base rules and is not kept; null languages and sources are groups of their
own; a group of a row or a few has its language's estimate all but unchanged; ties share a bin and enter the subset
together; SCALE_FLOOR keeps the scatter regular where a statistic is constant (so determinants are of the regularised
scatter); repeated rows count each; extra columns pass through where their names don't clash; an empty table gives an
empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellgrain.llm.common import cut, lookup_join

#: Share of rows in the subset, rows that an estimate's parent counts for, and the tail of the chi-square distribution.
SUPPORT, PRIOR, TAIL = 0.75, 100, 1e-9
#: A step must lower the log determinant by so much to be followed by another one.
GAIN = 1e-3
STATS = ("z1", "z2", "z3", "z4")
#: Standard deviation added in quadrature to each statistic's, in its own unit.
SCALE_FLOOR = (0.08, 0.06, 0.12, 0.12)
FINE, BIN, STARTS = 100, 32, 3
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
P = range(1, len(STATS) + 1)
TRIANGLE = [(r, c) for r in P for c in range(1, r + 1)]
ESTIMATE = [f"m{r}" for r in P] + [f"c{r}{c}" for r, c in TRIANGLE]
FACTOR = [f"i{r}{c}" for r, c in TRIANGLE]


def chi2_cdf(x: float, even: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, even // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, even: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, even) < p else (low, mid)
    return low


CUTOFF = round(chi2_quantile(1 - TAIL, len(STATS)), 6)
#: Makes the subset's covariance that of a normal distribution.
CONSISTENCY = round(SUPPORT / chi2_cdf(chi2_quantile(SUPPORT, len(STATS)), len(STATS) + 2), 9)


def base_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds BASE, counted over whole texts inside each row: no shuffle."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_t", t).withColumn("_w", F.expr(r"filter(split(_t, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"))
    df = df.withColumn("_l", F.expr(r"filter(split(_t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    df = df.withColumn("n_words", F.size("_w").cast("long")).withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
    df = df.withColumn("n_symbols", F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long"))
    df = df.withColumn("n_lines", F.size("_l").cast("long")).withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
    # Windows as 64-bit hashes; only texts that repeat one sort them with their places.
    df = df.withColumn("_h", F.expr("if(size(_w) < 3, cast(array() as array<bigint>), transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])))"))
    df = df.withColumn("_s", F.expr("if(size(array_distinct(_h)) = size(_h), cast(array() as array<struct<v:bigint,i:int>>), sort_array(transform(_h, (v, i) -> struct(v as v, i as i))))"))
    df = df.withColumn("_p", F.expr("sort_array(transform(filter(_s, (e, i) -> coalesce(get(_s, i - 1).v = e.v, false) or coalesce(get(_s, i + 1).v = e.v, false)), e -> e.i))"))
    df = df.withColumn("n_repeat_words", F.expr("aggregate(transform(_p, (q, i) -> least(3, coalesce(get(_p, i + 1) - q, 3))), 0L, (a, b) -> a + b)"))
    return df.drop("_t", "_w", "_l", "_h", "_s", "_p")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed(df: DataFrame) -> DataFrame:
    """The statistic vector: log mean word length, root of the symbol density, angles of the duplicate shares."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    z = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.sqrt(F.col("n_symbols") / n),
        F.asin(F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)))),
        F.asin(F.sqrt(F.col("n_repeat_words") / n)),
    )
    return df.withColumns({name: F.round(x, 6) for name, x in zip(STATS, z, strict=True)})


def labels(lang: str, source: str) -> list[Column]:
    """Names of the three groups of a row: all, its language, its language with its source. Lengths and marks of nulls
    keep different groups apart."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit("="), F.col(c)), F.lit("-"))
    return [F.lit("0"), F.concat(F.lit("1"), part(lang)), F.concat(F.lit("2"), part(lang), F.lit("|"), part(source))]


def medians(df: DataFrame, values: dict[str, Column], out: str) -> DataFrame:
    """Per group the lower median of each value on a grid of 1 / FINE, from counts of its cells."""
    cells = df.select("grp", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.floor(v * FINE).alias("b")) for k, v in values.items()))).alias("e")).select("grp", "e.k", "e.b")
    counts = cells.groupBy("grp", "k", "b").agg(F.count("*").alias("n"))
    w = Window.partitionBy("grp", "k")
    run = F.sum("n").over(w.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    hit = counts.withColumn("run", run).withColumn("all", F.sum("n").over(w)).where(2 * F.col("run") >= F.col("all"))
    low = hit.groupBy("grp", "k").agg(((F.min("b") + 0.5) / FINE).alias("v"))
    return low.groupBy("grp").agg(*(F.max(F.when(F.col("k") == k, F.col("v"))).alias(f"{out}{i}") for i, k in enumerate(values, 1)))


def factored(groups: DataFrame) -> DataFrame:
    """Adds the inverse Cholesky factor i11.. of the lower triangle c11.., by substitution, and the log determinant."""
    names = groups.columns
    for r, c in TRIANGLE:
        x = F.col(f"c{r}{c}")
        for k in range(1, c):
            x = x - F.col(f"l{r}{k}") * F.col(f"l{c}{k}")
        groups = groups.withColumn(f"l{r}{c}", F.sqrt(F.greatest(x, F.lit(1e-12))) if r == c else x / F.col(f"l{c}{c}"))
    for c in P:
        for r in range(c, P[-1] + 1):
            if r == c:
                x = 1 / F.col(f"l{r}{r}")
            else:
                x = F.lit(0.0)
                for k in range(c, r):
                    x = x - F.col(f"l{r}{k}") * F.col(f"i{k}{c}")
                x = x / F.col(f"l{r}{r}")
            groups = groups.withColumn(f"i{r}{c}", x)
    return groups.withColumn("det", 2 * sum((F.log(f"l{r}{r}") for r in P), F.lit(0.0))).select(*names, *FACTOR, "det")


def squared(df: DataFrame) -> Column:
    """Squared Mahalanobis distance of a row joined with its group's estimates."""
    total = F.lit(0.0)
    for r in range(1, len(STATS) + 1):
        y = F.lit(0.0)
        for c in range(1, r + 1):
            y = y + F.col(f"i{r}{c}") * (F.col(STATS[c - 1]) - F.col(f"m{c}"))
        total = total + y * y
    return total


def starts(rows: DataFrame) -> DataFrame:
    """A row for each group and start: the estimate that orders the rows of the first step."""
    centre = cut(medians(rows, {k: F.col(k) for k in STATS}, "m"))
    near = lookup_join(rows, centre, ["grp"], F.monotonically_increasing_id())
    spread = medians(near, {k: F.abs(F.col(k) - F.col(f"m{i}")) for i, k in enumerate(STATS, 1)}, "s")
    scale = centre.join(spread, "grp").select("grp", *(f"m{r}" for r in P), *(F.sqrt(F.pow(1.4826 * F.col(f"s{r}"), F.lit(2.0)) + SCALE_FLOOR[r - 1] ** 2).alias(f"s{r}") for r in P))
    scale = cut(scale)
    near = lookup_join(rows, scale, ["grp"], F.monotonically_increasing_id()).select("grp", *(((F.col(k) - F.col(f"m{r}")) / F.col(f"s{r}")).alias(f"u{r}") for r, k in enumerate(STATS, 1)))
    near = near.withColumn("u", F.greatest(F.sqrt(sum((F.col(f"u{r}") * F.col(f"u{r}") for r in P), F.lit(0.0))), F.lit(1e-9)))
    damped = [F.avg(F.tanh(f"u{r}") * F.tanh(f"u{c}")).alias(f"t{r}{c}") for r, c in TRIANGLE]
    directed = [(len(STATS) * F.avg(F.col(f"u{r}") / F.col("u") * F.col(f"u{c}") / F.col("u"))).alias(f"d{r}{c}") for r, c in TRIANGLE]
    sums = scale.join(near.groupBy("grp").agg(F.count("*").alias("n"), *damped, *directed), "grp")
    out = None
    for k in range(STARTS):
        cells = []
        for r, c in TRIANGLE:
            x = F.col(f"{'-td'[k]}{r}{c}") * F.col(f"s{r}") * F.col(f"s{c}") if k else (F.col(f"s{r}") * F.col(f"s{r}") if r == c else F.lit(0.0))
            cells.append((x + SCALE_FLOOR[r - 1] ** 2 if r == c else x).alias(f"c{r}{c}"))
        some = sums.select("grp", F.lit(k).alias("start"), "n", *(f"m{r}" for r in P), *cells)
        out = some if out is None else out.unionByName(some)
    return out


def concentrated(rows: DataFrame, groups: DataFrame, support: float) -> DataFrame:
    """One step: centre and regularised scatter of each group's nearest rows by its last estimate."""
    near = lookup_join(rows, groups.select("grp", "start", *(f"m{r}" for r in P), *FACTOR), ["grp"], F.monotonically_increasing_id(), "inner")
    near = near.withColumn("bin", F.floor(BIN * F.log1p(squared(near))))
    u = {r: F.col(STATS[r - 1]) - F.col(f"m{r}") for r in P}
    bins = near.groupBy("grp", "start", "bin").agg(F.count("*").alias("k"), *(F.sum(u[r]).alias(f"u{r}") for r in P), *(F.sum(u[r] * u[c]).alias(f"v{r}{c}") for r, c in TRIANGLE))
    w = Window.partitionBy("grp", "start")
    before = F.coalesce(F.sum("k").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = bins.withColumn("before", before).withColumn("all", F.sum("k").over(w)).where(F.col("before") < F.ceil(support * F.col("all")))
    sums = inside.groupBy("grp", "start").agg(F.sum("k").alias("k"), *(F.sum(f"u{r}").alias(f"u{r}") for r in P), *(F.sum(f"v{r}{c}").alias(f"v{r}{c}") for r, c in TRIANGLE))
    sums = sums.join(groups.select("grp", "start", "n", *(f"m{r}" for r in P)), ["grp", "start"])
    cells = []
    for r, c in TRIANGLE:
        cov = CONSISTENCY * (F.col(f"v{r}{c}") / F.col("k") - F.col(f"u{r}") * F.col(f"u{c}") / F.col("k") / F.col("k"))
        cells.append((cov + SCALE_FLOOR[r - 1] ** 2 if r == c else cov).alias(f"c{r}{c}"))
    return factored(sums.select("grp", "start", "n", *((F.col(f"m{r}") + F.col(f"u{r}") / F.col("k")).alias(f"m{r}") for r in P), *cells))


def fit(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row a group: n, centre m1.., scatter c11.. and det, the least of all starts. ``rows`` has grp and STATS."""
    state = cut(factored(starts(rows)).withColumn("det", F.lit(float("inf"))).withColumn("live", F.lit(True)))
    names = [*ESTIMATE, *FACTOR, "det"]
    while not state.where("live").isEmpty():  # every round lowers determinants, which SCALE_FLOOR bounds below
        live = state.where("live")
        new = concentrated(rows, live, support).select("grp", "start", *(F.col(c).alias(f"new_{c}") for c in names))
        both = live.join(new, ["grp", "start"])
        better = F.col("new_det") < F.col("det") - GAIN
        moved = both.select("grp", "start", "n", *(F.when(better, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in names), better.alias("live"))
        state = cut(state.where("not live").unionByName(moved))
    best = state.groupBy("grp").agg(F.min(F.struct("det", "start", "n", *ESTIMATE)).alias("e"))
    return best.select("grp", "e.n", *(f"e.{c}" for c in ESTIMATE), "e.det")


def estimates(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Per language and source (_own) the shrunk estimate and its factor. ``rows`` has the names of the three groups
    (_all, _lang, _own) and STATS."""
    e = cut(fit(rows.select(F.explode(F.array("_all", "_lang", "_own")).alias("grp"), *STATS), support))
    out = rows.select("_all", "_lang", "_own").distinct()
    for level in ("_own", "_lang", "_all"):
        some = e.select(F.col("grp").alias(level), F.struct("n", *ESTIMATE).alias(f"e{level}"))
        out = lookup_join(out, some, [level], F.monotonically_increasing_id(), "inner")
    share = {k: F.col(f"e{k}.n") / (F.col(f"e{k}.n") + PRIOR) for k in ("_own", "_lang")}
    mixed = [(share["_own"] * F.col(f"e_own.{c}") + (1 - share["_own"]) * (share["_lang"] * F.col(f"e_lang.{c}") + (1 - share["_lang"]) * F.col(f"e_all.{c}"))).alias(c) for c in ESTIMATE]
    return factored(out.select("_own", *mixed)).select("_own", *(f"m{r}" for r in P), *FACTOR)


def judge(docs: DataFrame, keep: list[str], lang: str = "lang", source: str = "source", text: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """The columns ``keep`` with BASE, base_failed, the distance (null where the base failed) and kept."""
    groups = [x.alias(k) for x, k in zip(labels(lang, source), ("_all", "_lang", "_own"), strict=True)]
    stats = base_stats(docs.select(*keep, *groups, F.col(text).alias("_text")), "_text").drop("_text")
    stats = cut(transformed(stats.withColumn("base_failed", base_failed())))
    fine = stats.where(~F.col("base_failed"))
    scored = lookup_join(fine, estimates(fine), ["_own"], F.monotonically_increasing_id())
    d2 = F.round(squared(scored), 6)
    scored = scored.select(*keep, *BASE, "base_failed", F.round(F.sqrt(d2), 4).alias("distance"), F.coalesce(d2 <= cutoff, F.lit(True)).alias("kept"))
    rest = stats.where("base_failed").select(*keep, *BASE, "base_failed", F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return scored.unionByName(rest)


def outlier_rules(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return judge(docs, ["doc_id"])


def sql(steps: int = 10) -> str:
    """The same over whole tables as DuckDB SQL, for data whose determinants stand still after ``steps``."""
    d2 = " + ".join("power(" + " + ".join(f"i{r}{c} * ({STATS[c - 1]} - m{c})" for c in range(1, r + 1)) + ", 2)" for r in P)
    floor = {r: repr(SCALE_FLOOR[r - 1] ** 2) for r in P}

    def median_of(name: str, source: str, values: list[str], out: str) -> str:
        cells = " UNION ALL ".join(f"SELECT grp, {i} AS k, floor({v} * {FINE}) AS b FROM {source}" for i, v in enumerate(values, 1))
        return f"""{name} AS MATERIALIZED (SELECT grp, {", ".join(f"max(v) FILTER (k = {i}) AS {out}{i}" for i in P)} FROM (
  SELECT grp, k, (min(b) + 0.5) / {FINE} AS v FROM (SELECT *, sum(n) OVER (PARTITION BY grp, k ORDER BY b) AS run, sum(n) OVER (PARTITION BY grp, k) AS total
    FROM (SELECT grp, k, b, count(*) AS n FROM ({cells}) GROUP BY ALL)) WHERE 2 * run >= total GROUP BY grp, k) GROUP BY grp)"""

    def factor(name: str, source: str, also: str = "") -> str:
        inner = f"SELECT * FROM ({source})"
        for r, c in TRIANGLE:
            x = f"c{r}{c}" + "".join(f" - l{r}{k} * l{c}{k}" for k in range(1, c))
            inner = f"SELECT *, {f'sqrt(greatest({x}, 1e-12))' if r == c else f'({x}) / l{c}{c}'} AS l{r}{c} FROM ({inner})"
        for c in P:
            for r in range(c, P[-1] + 1):
                x = f"1 / l{r}{r}" if r == c else "(0.0" + "".join(f" - l{r}{k} * i{k}{c}" for k in range(c, r)) + f") / l{r}{r}"
                inner = f"SELECT *, {x} AS i{r}{c} FROM ({inner})"
        return f"{name} AS MATERIALIZED (SELECT * EXCLUDE ({', '.join(f'l{r}{c}' for r, c in TRIANGLE)}), 2 * ({' + '.join(f'ln(l{r}{r})' for r in P)}) AS det{also} FROM ({inner}))"

    def start(k: int) -> str:
        cells = []
        for r, c in TRIANGLE:
            x = f"{'-td'[k]}{r}{c} * s{r} * s{c}" if k else (f"s{r} * s{r}" if r == c else "0.0")
            cells.append(f"{x}{f' + {floor[r]}' if r == c else ''} AS c{r}{c}")
        return f"SELECT grp, {k} AS start, n, {', '.join(f'm{r}' for r in P)}, {', '.join(cells)} FROM sums"

    part = lambda c: f"coalesce(length({c}) || '=' || {c}, '-')"
    parts = [
        rf"""d AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, '0' AS g0, '1' || {part("lang")} AS g1, '2' || {part("lang")} || '|' || {part("source")} AS g2,
  coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents)""",
        "g AS (SELECT row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))",
        "rep AS (SELECT row_id, count(DISTINCT pos) AS n FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY row_id, g) AS c FROM g) WHERE c > 1) GROUP BY row_id)",
        "b AS MATERIALIZED (SELECT doc_id, g0, g1, g2, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (row_id))",
        "z AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, round(ln(greatest(word_chars, 1) / greatest(n_words, 1)), 6) AS z1, round(sqrt(n_symbols / greatest(n_words, 1)), 6) AS z2, round(asin(sqrt(n_dup_lines / greatest(n_lines, 1))), 6) AS z3, round(asin(sqrt(n_repeat_words / greatest(n_words, 1))), 6) AS z4 FROM b)",
        "f AS MATERIALIZED (SELECT * FROM z WHERE NOT base_failed)",
        "r AS MATERIALIZED (SELECT unnest([g0, g1, g2]) AS grp, z1, z2, z3, z4 FROM f)",
        median_of("centre", "r", list(STATS), "m"),
        median_of("spread", "(SELECT * FROM r JOIN centre USING (grp))", [f"abs(z{i} - m{i})" for i in P], "s"),
        f"scale AS MATERIALIZED (SELECT grp, {', '.join(f'm{r}' for r in P)}, {', '.join(f'sqrt(power(1.4826 * s{r}, 2) + {floor[r]}) AS s{r}' for r in P)} FROM centre JOIN spread USING (grp))",
        f"u AS MATERIALIZED (SELECT *, greatest(sqrt({' + '.join(f'u{r} * u{r}' for r in P)}), 1e-9) AS u FROM (SELECT grp, {', '.join(f'(z{r} - m{r}) / s{r} AS u{r}' for r in P)} FROM r JOIN scale USING (grp)))",
        f"sums AS MATERIALIZED (SELECT * FROM scale JOIN (SELECT grp, count(*) AS n, {', '.join(f'avg(tanh(u{r}) * tanh(u{c})) AS t{r}{c}' for r, c in TRIANGLE)}, {', '.join(f'{len(STATS)} * avg(u{r} / u * u{c} / u) AS d{r}{c}' for r, c in TRIANGLE)} FROM u GROUP BY grp) USING (grp))",
        factor("x0", " UNION ALL ".join(start(k) for k in range(STARTS))),
        "e0 AS MATERIALIZED (SELECT * REPLACE (CAST('inf' AS DOUBLE) AS det), true AS live FROM x0)",
    ]
    for s in range(steps):
        moved = ", ".join(f"CASE WHEN n.det < e.det - {GAIN} THEN n.{c} ELSE e.{c} END AS {c}" for c in [*ESTIMATE, *FACTOR, "det"])
        parts += [
            f"""bins{s} AS (SELECT grp, start, bin, count(*) AS k, {", ".join(f"sum(z{r} - m{r}) AS u{r}" for r in P)}, {", ".join(f"sum((z{r} - m{r}) * (z{c} - m{c})) AS v{r}{c}" for r, c in TRIANGLE)} FROM (
  SELECT *, floor({BIN} * ln(1 + {d2})) AS bin FROM r JOIN e{s} USING (grp) WHERE live) GROUP BY grp, start, bin)""",
            f"""sums{s} AS (SELECT grp, start, sum(k) AS k, {", ".join(f"sum(u{r}) AS u{r}" for r in P)}, {", ".join(f"sum(v{r}{c}) AS v{r}{c}" for r, c in TRIANGLE)} FROM (
  SELECT *, coalesce(sum(k) OVER (PARTITION BY grp, start ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior, sum(k) OVER (PARTITION BY grp, start) AS total FROM bins{s}) WHERE prior < ceil({SUPPORT} * total) GROUP BY grp, start)""",
            factor(f"x{s + 1}", f"SELECT grp, start, n, {', '.join(f'm{r} + u{r} / k AS m{r}' for r in P)}, {', '.join(f'{CONSISTENCY!r} * (v{r}{c} / k - u{r} * u{c} / k / k)' + (f' + {floor[r]}' if r == c else '') + f' AS c{r}{c}' for r, c in TRIANGLE)} FROM sums{s} JOIN (SELECT grp, start, n, {', '.join(f'm{r}' for r in P)} FROM e{s}) USING (grp, start)"),
            f"e{s + 1} AS MATERIALIZED (SELECT e.grp, e.start, e.n, {moved}, coalesce(n.det < e.det - {GAIN}, false) AS live FROM e{s} e LEFT JOIN x{s + 1} n USING (grp, start))",
        ]
    mixed = ", ".join(f"o.n / (o.n + {PRIOR}) * o.{c} + (1 - o.n / (o.n + {PRIOR})) * (l.n / (l.n + {PRIOR}) * l.{c} + (1 - l.n / (l.n + {PRIOR})) * a.{c}) AS {c}" for c in ESTIMATE)
    parts += [
        f"best AS MATERIALIZED (SELECT * FROM e{steps} QUALIFY row_number() OVER (PARTITION BY grp ORDER BY det, start) = 1)",
        factor("own", f"SELECT g2, {mixed} FROM (SELECT DISTINCT g0, g1, g2 FROM f) JOIN best o ON o.grp = g2 JOIN best l ON l.grp = g1 JOIN best a ON a.grp = g0"),
    ]
    out = ", ".join(f"CAST({x} AS BIGINT) AS {x}" for x in BASE)
    return f"""WITH {", ".join(parts)}
SELECT doc_id, {out}, base_failed, round(sqrt(d2), 4) AS distance, coalesce(d2 <= {CUTOFF!r}, true) AS kept FROM (SELECT *, round({d2}, 6) AS d2 FROM f JOIN own USING (g2))
UNION ALL SELECT doc_id, {out}, base_failed, NULL, false FROM z WHERE base_failed"""
