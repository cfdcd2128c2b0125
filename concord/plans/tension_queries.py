"""Queries on tension: the diagnostics of version 1, the states and fits of version 2."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import holds, r6
from ..operators import center, states
from ..operators import tension as T
from ..operators.checkpoints import cut
from ..operators.ranks import percent_rank
from .views import Tables, with_views

B1, B2 = T.Pair("b", "log_a", "l68", "u68", "b", "b_err", 0.1), T.Pair("b2", "log_a", "l68", "u68", "b2", "b2_err", 0.2)
GATES_SQL = {"class": "class = 0", "converged": "b IS NOT NULL AND b2 IS NOT NULL", "plausible": "b > 1e3 AND log_a > 3.0 AND b2 > 0", "coverage": "n >= 2"}
SAMPLE_SQL = f"SELECT * FROM est_a JOIN est_b USING (id) WHERE {' AND '.join(f'({g})' for g in GATES_SQL.values())}"


def _t_sql(name: str, b: str, err: str, floor: float) -> str:
    s_b = f"CASE WHEN {err} > 0 THEN {err} / ({b} * 2.302585::DOUBLE) END"
    return f"log_a - log10({b}) AS delta_{name}, (u68 - l68) / 2 AS sigma_a_{name}, {s_b} AS sigma_b_{name}, (log_a - log10({b})) / sqrt(((u68 - l68) / 2) ** 2 + ({s_b}) ** 2 + {floor * floor}::DOUBLE) AS t_{name}"


def tension_sql(body: str) -> str:
    return with_views(f"""WITH sample AS ({SAMPLE_SQL}), t AS (SELECT *, {_t_sql('b', 'b', 'b_err', 0.1)}, {_t_sql('b2', 'b2', 'b2_err', 0.2)},
      log_a / nullif(chi, 0) AS chi_ratio, percent_rank() OVER (ORDER BY chi NULLS LAST) * 100 AS chi_pctile, q > 100 AS has_many, log_a < 5 AS is_low FROM sample) {body}""", "est_a", "est_b")  # fmt: skip


def gates() -> dict:
    return {name: F.expr(text) for name, text in GATES_SQL.items()}


def sample(t: Tables) -> DataFrame:
    return T.plausible(t.est_a().join(t.est_b(), "id"), gates())


def scored_sample(t: Tables, ranks: bool = False) -> DataFrame:
    rows = T.with_tension(sample(t), [B1, B2])
    rows = rows.withColumns({"chi_ratio": F.try_divide(F.col("log_a"), F.when(F.col("chi") != 0, F.col("chi"))), "has_many": F.col("q") > 100, "is_low": F.col("log_a") < 5})
    return percent_rank(rows, "chi", "chi_pctile").withColumn("chi_pctile", F.col("chi_pctile") * 100) if ranks else rows


def rounded(df: DataFrame) -> DataFrame:
    """All double columns rounded to six places."""
    return df.select(*[r6(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


TENSION_COLUMNS = ["id", *[f"{c}_{p}" for p in ("b", "b2") for c in ("delta", "sigma_a", "sigma_b", "t")], "log_a", "chi", "chi_ratio", "chi_pctile", "n", "has_many", "is_low"]


def tension(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scored_sample(Tables(spark, d), True).select(*TENSION_COLUMNS))


def _round_sql(columns: list[str], keep: set[str]) -> str:
    return ", ".join(c if c in keep else f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in columns)


SQL: dict[str, str] = {"tension": tension_sql(f"SELECT {_round_sql(TENSION_COLUMNS, {'id', 'n', 'has_many', 'is_low'})} FROM t")}


def tension_invariants(spark: SparkSession, d: str) -> DataFrame:
    x = scored_sample(Tables(spark, d), True)
    zero = {"null_delta": F.col("delta_b").isNull(), "null_sigma_a": F.col("sigma_a_b").isNull(), "t_without_sigma": F.col("t_b").isNotNull() & F.col("sigma_b_b").isNull(), "sigma_without_t": F.col("t_b").isNull() & F.col("sigma_b_b").isNotNull(), "not_finite": holds(F.isnan("t_b") | (F.abs("t_b") == float("inf"))), "b_not_positive": F.col("b") <= 0, "too_few": F.col("n") < 2}
    return rounded(x.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"), *[F.count_if(c).alias(k) for k, c in zero.items()], F.min("chi_pctile").alias("pctile_lo"), F.max("chi_pctile").alias("pctile_hi")))


SQL["tension_invariants"] = tension_sql("""SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, count(*) FILTER (delta_b IS NULL) AS null_delta, count(*) FILTER (sigma_a_b IS NULL) AS null_sigma_a,
  count(*) FILTER (t_b IS NOT NULL AND sigma_b_b IS NULL) AS t_without_sigma, count(*) FILTER (t_b IS NULL AND sigma_b_b IS NOT NULL) AS sigma_without_t, count(*) FILTER (isnan(t_b) OR isinf(t_b)) AS not_finite,
  count(*) FILTER (b <= 0) AS b_not_positive, count(*) FILTER (n < 2) AS too_few, round(min(chi_pctile), 6) AS pctile_lo, round(max(chi_pctile), 6) AS pctile_hi FROM t""")


def pull_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(T.pull_stats(scored_sample(Tables(spark, d)), ["t_b", "t_b2"]))


SQL["pull_stats"] = tension_sql("""WITH l AS (SELECT 't_b' AS scalar, t_b AS v FROM t UNION ALL SELECT 't_b2', t_b2 FROM t),
  k AS (SELECT scalar, v FROM l WHERE v IS NOT NULL), m AS (SELECT scalar, v, avg(v) OVER w AS mean, stddev_samp(v) OVER w AS sd FROM k WINDOW w AS (PARTITION BY scalar))
  SELECT scalar, count(*) AS n, round(any_value(mean), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median, round(any_value(sd), 6) AS sd, round(min(v), 6) AS lo, round(max(v), 6) AS hi,
  round(avg((abs(v) > 2)::INT), 6) AS frac_gt_2, round(avg((abs(v) > 3)::INT), 6) AS frac_gt_3, round(avg((abs(v) > 5)::INT), 6) AS frac_gt_5,
  round(avg(((v - mean) / nullif(sd, 0)) ** 3), 6) AS skewness, round(avg(((v - mean) / nullif(sd, 0)) ** 4) - 3, 6) AS kurtosis FROM m GROUP BY scalar""".replace("WITH l", ", l", 1))  # fmt: skip


def chi2_corr(spark: SparkSession, d: str) -> DataFrame:
    a, b, c = F.abs("t_b"), F.abs("t_b2"), F.col("chi")
    return rounded(T.correlations(scored_sample(Tables(spark, d)), {"abs_t_b_vs_chi": (a, c), "abs_t_b2_vs_chi": (b, c), "t_b_vs_t_b2": (F.col("t_b"), F.col("t_b2"))}))


SQL["chi2_corr"] = tension_sql("SELECT round(corr(abs(t_b), chi), 6) AS abs_t_b_vs_chi, round(corr(abs(t_b2), chi), 6) AS abs_t_b2_vs_chi, round(corr(t_b, t_b2), 6) AS t_b_vs_t_b2 FROM t")


def zombie_check(spark: SparkSession, d: str) -> DataFrame:
    x, lb = scored_sample(Tables(spark, d)), F.log10("b")
    return rounded(x.agg(F.min(lb).alias("min_log_b"), F.max(lb).alias("max_log_b"), F.min("log_a").alias("min_log_a"), F.max("log_a").alias("max_log_a"), F.count_if(F.abs("delta_b") > 0.5).alias("n_extreme"), F.min(F.when(F.col("is_low"), F.col("log_a"))).alias("min_low")))


SQL["zombie_check"] = tension_sql("SELECT round(min(log10(b)), 6) AS min_log_b, round(max(log10(b)), 6) AS max_log_b, round(min(log_a), 6) AS min_log_a, round(max(log_a), 6) AS max_log_a, count(*) FILTER (abs(delta_b) > 0.5) AS n_extreme, round(min(log_a) FILTER (is_low), 6) AS min_low FROM t")


def context_grid(spark: SparkSession, d: str) -> DataFrame:
    return rounded(T.boolean_grid(scored_sample(Tables(spark, d)), "is_low", "has_many", F.abs("t_b2")))


SQL["context_grid"] = tension_sql("""SELECT g.is_low, h.has_many, count(t.id) AS n, round(count(t.id)::DOUBLE / (SELECT count(*) FROM t) * 100, 6) AS pct, round(quantile_cont(abs(t_b2), 0.5), 6) AS median
  FROM (VALUES (true), (false)) g(is_low) CROSS JOIN (VALUES (true), (false)) h(has_many) LEFT JOIN t ON t.is_low = g.is_low AND t.has_many = h.has_many GROUP BY ALL""")


def attrition(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rounded(T.attrition(t.est_a().join(t.est_b(), "id", "left"), gates()))


_STAGES = ["true", *[" AND ".join(f"({g})" for g in [*GATES_SQL.values()][: i + 1]) for i in range(len(GATES_SQL))]]
SQL["attrition"] = with_views("WITH j AS (SELECT * FROM est_a LEFT JOIN est_b USING (id)) " + " UNION ALL ".join(f"SELECT {i}::INT AS stage_no, '{n}' AS stage, count(*) FILTER ({s}) AS n, round(count(*) FILTER ({s}) * 100.0::DOUBLE / count(*), 6) AS pct FROM j" for i, (n, s) in enumerate(zip(["total", *GATES_SQL], _STAGES, strict=True))), "est_a", "est_b")


def analysis_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample(Tables(spark, d)).select("id")


SQL["analysis_sample"] = with_views(f"SELECT id FROM ({SAMPLE_SQL})", "est_a", "est_b")


def delta_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return rounded(T.abs_percentiles(scored_sample(Tables(spark, d)), "delta_b"))


SQL["delta_percentiles"] = tension_sql("SELECT count(delta_b) AS n, " + ", ".join(f"round(quantile_cont(abs(delta_b), {p}), 6) AS p{round(p * 100)}" for p in (0.5, 0.9, 0.95, 0.99)) + ", round(max(abs(delta_b)), 6) AS max_abs, " + ", ".join(f"count(*) FILTER (abs(delta_b) > {x}) AS n_gt_{i}, round(count(*) FILTER (abs(delta_b) > {x}) * 100.0::DOUBLE / count(delta_b), 6) AS pct_gt_{i}" for i, x in enumerate((0.1, 0.3))) + " FROM t")


def topk_instability(spark: SparkSession, d: str) -> DataFrame:
    x = scored_sample(Tables(spark, d)).select("id", "t_b", "t_b2")
    lost = T.not_shared(x, "t_b", "t_b2", "id", 200).agg(F.count(F.lit(1)).alias("n_not_shared")).withColumn("k", F.lit(1))
    signs = x.agg(F.count_if(F.signum("t_b") != F.signum("t_b2")).alias("n_sign_mismatch"), F.corr("t_b", "t_b2").alias("corr")).withColumn("k", F.lit(1))
    return rounded(signs.join(lost, "k").drop("k"))


SQL["topk_instability"] = tension_sql("""SELECT (SELECT count(*) FROM t WHERE sign(t_b) <> sign(t_b2)) AS n_sign_mismatch, (SELECT round(corr(t_b, t_b2), 6) FROM t) AS corr,
  (SELECT count(*) FROM (SELECT id FROM t WHERE t_b IS NOT NULL ORDER BY abs(t_b) DESC, id LIMIT 200) WHERE id NOT IN (SELECT id FROM t WHERE t_b2 IS NOT NULL ORDER BY abs(t_b2) DESC, id LIMIT 200)) AS n_not_shared""")


# ---- version 2 ---------------------------------------------------------------
def perturbed(t: Tables) -> DataFrame:
    """Estimates with every kind of bad input, by id."""
    i = F.col("id")
    x = t.est_a().join(t.est_b(), "id", "left")
    return x.select(
        "id", "class", F.when(i % 43 == 0, -99.9).otherwise(F.col("log_a")).alias("a.log"), F.when(i % 53 == 0, None).otherwise(F.col("l68")).alias("a.low"), F.when(i % 47 == 0, F.col("l68") - 1).otherwise(F.col("u68")).alias("a.high"),
        F.when(i % 23 == 0, 0.0).when(i % 29 == 0, -F.col("b")).when(i % 31 == 0, None).otherwise(F.col("b")).alias("b.x"),
        F.when(i % 37 == 0, None).when(i % 41 == 0, -1.0).otherwise(F.col("b_err") / 4).alias("b.x_err"), F.when(i % 59 == 0, 0.0).otherwise(F.col("b2")).alias("b.y"), (F.col("b2_err") * 2).alias("b.y_err"),
        (F.col("log_a") - 12).alias("a.ratio"), F.col("chi").alias("ctx_chi"),
    )


MACHINES = (
    states.point_machine("x", "a.log", "b.x"),
    states.scale_machine("x_scale", "x", "point_valid", "a.low", "a.high", "b.x", "b.x_err", True),
    states.point_machine("y", "a.log", "b.y", "b.y_err"),
    states.scale_machine("y_scale", "y", "point_comparable", "a.low", "a.high", "b.y", "b.y_err", False),
    states.ratio_machine("ratio", "x_state == 'point_valid' AND y_state == 'point_comparable'", "a.ratio"),
)


def state_machine(spark: SparkSession, d: str) -> DataFrame:
    x = states.run_machines(perturbed(Tables(spark, d)), MACHINES)
    x = states.scored(x, "x", "`a.log`", "`a.low`", "`a.high`", "`b.x`", "`b.x_err`", F.lit(0.05), 0.1, "point_valid")
    x = states.scored(x, "y", "`a.log`", "`a.low`", "`a.high`", "`b.y`", "`b.y_err`", F.lit(0.1), 0.2, "point_comparable")
    delta_ratio = F.when(F.col("ratio_state") == "point_valid", F.col("`a.ratio`") - (F.log10("`b.y`") - F.log10("`b.x`")))
    out = x.withColumns({"delta_ratio": delta_ratio, "pop_x": holds((F.col("class") == 0) & (F.col("x_state") == "point_valid")), "pop_y": holds((F.col("class") == 0) & (F.col("y_state") == "point_comparable"))})
    names = [f"{m.name}_{c}" for m in MACHINES for c in ("state", "reason")]
    return rounded(out.select("id", *names, *[f"{c}_{q}" for q in ("x", "y") for c in ("delta", "residual", "sigma_a", "sigma_b", "score")], "score_x_state", "score_y_state", "delta_ratio", "pop_x", "pop_y", "ctx_chi"))


def _machine_sql(m: states.Machine) -> str:
    def sql(text: str) -> str:
        for n in ("a.log", "a.low", "a.high", "a.ratio", "b.x_err", "b.x", "b.y_err", "b.y"):
            text = text.replace(n, n.replace(".", "_"))
        return re.sub(r"is_null\((\w+)\)", r"\1 IS NULL", text).replace("==", "=")

    parts = []
    for k, c in ((0, "state"), (1, "reason")):
        body = "CASE " + " ".join(f"WHEN {sql(r[2])} THEN '{r[k]}'" for r in m.rules) + " END"
        parts.append((f"CASE WHEN {sql(m.precondition)} THEN {body} ELSE '{('invalid_or_unsupported', 'parent_state_not_permitted')[k]}' END" if m.precondition else body) + f" AS {m.name}_{c}")
    return ", ".join(parts)


def _scored_sql(n: str, permitted: str, expected: float, floor: float) -> str:
    ok, scale = f"{n}_state = '{permitted}'", f"{n}_scale_state = 'point_valid'"
    s_b = f"(b_{n}_err / (b_{n} * 2.302585092994046::DOUBLE))"
    comb = f"sqrt(((a_high - a_low) / 2) ** 2 + {s_b} ** 2 + {floor * floor}::DOUBLE)"
    delta = f"CASE WHEN {ok} THEN a_log - log10(b_{n}) END"
    usable = f"{ok} AND {scale} AND {comb} >= 1e-12"
    return (f"{delta} AS delta_{n}, {delta} - {expected} AS residual_{n}, CASE WHEN {ok} AND {scale} THEN (a_high - a_low) / 2 END AS sigma_a_{n}, CASE WHEN {ok} AND {scale} THEN {s_b} END AS sigma_b_{n}, "
            f"CASE WHEN {usable} THEN (a_log - log10(b_{n}) - {expected}) / {comb} END AS score_{n}, CASE WHEN {usable} THEN 'point_valid' WHEN {ok} AND {scale} THEN 'zero_combined_scale' WHEN {n}_scale_state = 'approximation_out_of_domain' THEN 'approximation_out_of_domain' ELSE 'unsupported_scale' END AS score_{n}_state")  # fmt: skip


_STATE_NAMES = [f"{m.name}_{c}" for m in MACHINES for c in ("state", "reason")]
_NUM = [f"{c}_{q}" for q in ("x", "y") for c in ("delta", "residual", "sigma_a", "sigma_b", "score")]
SQL["state_machine"] = with_views(f"""WITH p AS (SELECT id, class, CASE WHEN id % 43 = 0 THEN -99.9 ELSE log_a END AS a_log, CASE WHEN id % 53 = 0 THEN NULL ELSE l68 END AS a_low, CASE WHEN id % 47 = 0 THEN l68 - 1 ELSE u68 END AS a_high,
  CASE WHEN id % 23 = 0 THEN 0.0 WHEN id % 29 = 0 THEN -b WHEN id % 31 = 0 THEN NULL ELSE b END AS b_x, CASE WHEN id % 37 = 0 THEN NULL WHEN id % 41 = 0 THEN -1.0 ELSE b_err / 4 END AS b_x_err,
  CASE WHEN id % 59 = 0 THEN 0.0 ELSE b2 END AS b_y, b2_err * 2 AS b_y_err, log_a - 12 AS a_ratio, chi AS ctx_chi FROM est_a LEFT JOIN est_b USING (id)),
  m1 AS (SELECT *, {_machine_sql(MACHINES[0])}, {_machine_sql(MACHINES[2])} FROM p), m2 AS (SELECT *, {_machine_sql(MACHINES[1])}, {_machine_sql(MACHINES[3])}, {_machine_sql(MACHINES[4])} FROM m1),
  s AS (SELECT *, {_scored_sql('x', 'point_valid', 0.05, 0.1)}, {_scored_sql('y', 'point_comparable', 0.1, 0.2)} FROM m2)
  SELECT id, {', '.join(_STATE_NAMES)}, {_round_sql(_NUM, set())}, score_x_state, score_y_state, round(CASE WHEN ratio_state = 'point_valid' THEN a_ratio - (log10(b_y) - log10(b_x)) END, 6) + 0.0::DOUBLE AS delta_ratio,
  coalesce(class = 0 AND x_state = 'point_valid', false) AS pop_x, coalesce(class = 0 AND y_state = 'point_comparable', false) AS pop_y, round(ctx_chi, 6) AS ctx_chi FROM s""", "est_a", "est_b")  # fmt: skip

SUPPORT = 30


def _development(t: Tables) -> DataFrame:
    return scored_sample(t).withColumn("split", F.when(F.col("custkey") % 5 < 3, "development").when(F.col("custkey") % 5 == 3, "validation").otherwise("holdout"))


def _fit(t: Tables):
    rows = cut(_development(t).select("id", "split", "month", "price", "delta_b"))  # fitted on, and scored, several times
    dev = rows.filter(center.is_development(F.col("split")))
    edges = center.quantile_edges(dev, "month", "price", (6, 5))
    return rows, center.fit_center(dev, "delta_b", "month", "price", edges), edges


def center_fit(spark: SparkSession, d: str) -> DataFrame:
    fit = _fit(Tables(spark, d))[1]
    return rounded(fit.withColumn("xb", F.coalesce("xb", F.lit(-1))).withColumn("yb", F.coalesce("yb", F.lit(-1))))


def center_apply(spark: SparkSession, d: str) -> DataFrame:
    rows, fit, edges = _fit(Tables(spark, d))
    out = center.apply_center(rows, fit, "month", "price", edges, SUPPORT)
    return rounded(out.select("id", "expected", "center_support", (F.col("delta_b") - F.col("expected")).alias("residual")))


def _bin_sql(c: str, edges: str) -> str:
    return f"CASE WHEN {c} < list_max({edges}) AND {c} >= list_min({edges}) THEN len(list_filter(list_distinct({edges}), lambda e: e <= {c})) - 1 END::INT"


_CENTER = f"""WITH s AS (SELECT *, CASE WHEN custkey % 5 < 3 THEN 'development' WHEN custkey % 5 = 3 THEN 'validation' ELSE 'holdout' END AS split FROM t), dev AS (SELECT * FROM s WHERE split = 'development'),
  e AS (SELECT [{', '.join(f'quantile_cont(month, {i}/6.0::DOUBLE)' for i in range(7))}] AS xe, [{', '.join(f'quantile_cont(price, {i}/5.0::DOUBLE)' for i in range(6))}] AS ye FROM dev),
  db AS (SELECT delta_b, {_bin_sql('month', 'xe')} AS xb, {_bin_sql('price', 'ye')} AS yb FROM dev, e WHERE delta_b IS NOT NULL),
  fit AS (SELECT 'cell' AS level, xb, yb, count(*) AS n, quantile_cont(delta_b, 0.5) AS value FROM db WHERE xb IS NOT NULL AND yb IS NOT NULL GROUP BY xb, yb
    UNION ALL SELECT 'x', xb, NULL, count(*), quantile_cont(delta_b, 0.5) FROM db WHERE xb IS NOT NULL GROUP BY xb UNION ALL SELECT 'global', NULL, NULL, count(*), quantile_cont(delta_b, 0.5) FROM db)""".replace("WITH s", ", s", 1)  # fmt: skip
SQL["center_fit"] = tension_sql(_CENTER + " SELECT level, coalesce(xb, -1) AS xb, coalesce(yb, -1) AS yb, n, round(value, 6) + 0.0::DOUBLE AS value FROM fit")
SQL["center_apply"] = tension_sql(_CENTER + f""", b AS (SELECT s.*, {_bin_sql('month', 'xe')} AS xb, {_bin_sql('price', 'ye')} AS yb FROM s, e),
  j AS (SELECT b.id, delta_b, b.xb IS NOT NULL AND b.yb IS NOT NULL AS hull, c.value AS cv, l.value AS lv, g.value AS gv FROM b LEFT JOIN fit c ON c.level = 'cell' AND c.xb = b.xb AND c.yb = b.yb AND c.n >= {SUPPORT}
    LEFT JOIN fit l ON l.level = 'x' AND l.xb = b.xb AND l.n >= {SUPPORT} LEFT JOIN fit g ON g.level = 'global')
  SELECT id, round(CASE WHEN hull THEN coalesce(cv, lv, gv) ELSE gv END, 6) + 0.0::DOUBLE AS expected, CASE WHEN NOT hull THEN 'out_of_hull' WHEN cv IS NOT NULL THEN 'cell' WHEN lv IS NOT NULL THEN 'z_fallback' ELSE 'global_fallback' END AS center_support,
  round(delta_b - CASE WHEN hull THEN coalesce(cv, lv, gv) ELSE gv END, 6) + 0.0::DOUBLE AS residual FROM j""")  # fmt: skip

FLOORS = tuple(round(0.02 * i, 2) for i in range(16))


def sigma_sys(spark: SparkSession, d: str) -> DataFrame:
    dev = _development(Tables(spark, d)).filter(center.is_development(F.col("split")))
    return rounded(center.spread_by_floor(dev, "delta_b", "sigma_a_b", "sigma_b_b", FLOORS))


SQL["sigma_sys"] = tension_sql(f""", r AS (SELECT f.floor, delta_b / sqrt(sigma_a_b ** 2 + sigma_b_b ** 2 + f.floor ** 2) AS v FROM t, (SELECT unnest([{', '.join(f'{x}::DOUBLE' for x in FLOORS)}]) AS floor) f
  WHERE custkey % 5 < 3 AND delta_b IS NOT NULL AND sigma_a_b IS NOT NULL AND sigma_b_b IS NOT NULL), m AS (SELECT floor, quantile_cont(v, 0.5) AS m FROM r GROUP BY floor)
  SELECT r.floor, round(quantile_cont(abs(v - m), 0.5) * 1.4826, 6) AS spread FROM r JOIN m USING (floor) GROUP BY r.floor""")  # fmt: skip


def fit_guard(spark: SparkSession, d: str) -> DataFrame:
    """A fit asked for by priority: rows of the other splits among the training rows, orders of status P given twice or in two splits."""
    o = Tables(spark, d).orders
    split = F.when(F.col("o_orderstatus") == "O", "development").when(F.col("o_totalprice") < 50_000, "validation").when(F.col("o_totalprice") > 400_000, "holdout").otherwise("development")
    rows = o.select(F.col("o_orderpriority").alias("request"), F.col("o_orderkey").alias("id"), split.alias("split"), "o_orderstatus", "o_totalprice")
    twice = rows.filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 20_000))
    training = rows.filter("split = 'development' or o_totalprice < 30000").select("request", "id").unionByName(twice.select("request", "id"))
    splits = rows.select("request", "id", "split").unionByName(rows.filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 420_000)).select("request", "id", F.lit("other").alias("split")))
    return center.refused_fits(training, splits)


SQL["fit_guard"] = """WITH r AS (SELECT o_orderpriority AS request, o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'development' WHEN o_totalprice < 50000 THEN 'validation' WHEN o_totalprice > 400000 THEN 'holdout' ELSE 'development' END AS split, o_orderstatus AS st, o_totalprice AS p FROM orders),
  tr AS (SELECT request, id FROM r WHERE split = 'development' OR p < 30000 UNION ALL SELECT request, id FROM r WHERE st = 'P' AND p < 20000), sp AS (SELECT request, id, split FROM r UNION ALL SELECT request, id, 'other' FROM r WHERE st = 'P' AND p > 420000)
  SELECT DISTINCT request, id, 'held_out_row' AS reason FROM tr WHERE (request, id) IN (SELECT request, id FROM sp WHERE split IN ('validation', 'holdout'))
  UNION ALL SELECT request, id, 'in_two_partitions' FROM sp GROUP BY request, id HAVING count(DISTINCT split) > 1 UNION ALL SELECT request, id, 'duplicate_training_row' FROM tr GROUP BY request, id HAVING count(*) > 1"""  # fmt: skip

QUERIES = {f.__name__: f for f in (tension, tension_invariants, pull_stats, chi2_corr, zombie_check, context_grid, attrition, analysis_sample, delta_percentiles, topk_instability, state_machine, center_fit, center_apply, sigma_sys, fit_guard)}
