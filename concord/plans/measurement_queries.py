"""Queries on repeat measurements, their sources, and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import binned, edge_names, finite, r6
from ..operators import measure as M
from ..operators import splits as S
from .views import Tables, with_views

SALT = "concord-tiles-1"
VARIANTS = (("confidence_80", 80, None, None), ("threshold_0.5", 95, 0.5, None), ("threshold_9", 95, 9.0, None), ("normalized_2", 95, None, 2.0))

_VALID = "(coalesce(isfinite(z), false) AND z > 0)"
_WANT = "CASE WHEN flag IN (1, 11) THEN 50 WHEN flag IN (2, 12) THEN 80 WHEN flag IN (3, 13) THEN 95 WHEN flag IN (4, 14) THEN 97 WHEN flag IN (9, 19) THEN 85 END"
_SECURE = f"({_VALID} AND coalesce(flag IN (3, 4, 13, 14) AND conf BETWEEN 95 AND 100 AND conf = {_WANT}, false))"
#: Measurements with their predicates; those of known entities; the same of the unique ones.
_BASE = f"""WITH mm AS (SELECT *, {_VALID} AS valid, {_SECURE} AS sec, {_WANT} AS want, ent IN (SELECT id FROM cat) AS known FROM meas),
 am AS (SELECT * FROM mm WHERE known AND ent <> -999), um AS (SELECT * FROM am WHERE prio = 1)"""


def measurement_sql(body: str) -> str:
    return with_views(f"{_BASE} {body}", "meas", "cat")


def joined(*columns: str) -> list:
    return [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in columns]


SQL: dict[str, str] = {}


def measurement_audit(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = M.audit(t.meas(), t.cat())
    return out.select(*[c for c in out.columns if c not in ("block_reasons", "native_z")], r6(F.col("native_z")).alias("native_z"), *joined("block_reasons"))


SQL["measurement_audit"] = measurement_sql("""SELECT id, ent AS native_ent, flag AS native_flag, conf AS native_conf, prio AS native_prio,
  CASE WHEN ent = -999 THEN 'no_association_sentinel' WHEN known THEN 'associated' ELSE 'unresolved_identifier' END AS association, CASE WHEN ent <> -999 AND known THEN ent END AS resolved, prio = 1 AS is_unique_member, valid AS valid_z,
  CASE WHEN z IS NULL THEN 'z_missing' WHEN NOT isfinite(z) THEN 'z_non_finite' WHEN z <= 0 THEN 'z_non_positive' END AS z_reason,
  CASE WHEN flag IS NULL THEN 'flag_missing' WHEN flag IN (0, 10) THEN 'non_measured' WHEN flag IN (1, 2, 3, 4, 9, 11, 12, 13, 14, 19) THEN 'recognized_measured' ELSE 'unrecognized' END AS flag_category,
  coalesce(conf BETWEEN 0 AND 100, false) AS conf_in_domain, CASE WHEN want IS NOT NULL THEN conf IS NOT DISTINCT FROM want END AS mapping_consistent, sec AS secure, round(z, 6) + 0.0::DOUBLE AS native_z,
  concat_ws(',', CASE WHEN NOT valid THEN 'preferred_z_not_numeric_valid' END, CASE WHEN NOT coalesce(flag IN (3, 4, 13, 14), false) THEN 'preferred_flag_not_in_secure_domain' END, CASE WHEN NOT coalesce(conf BETWEEN 0 AND 100, false) THEN 'preferred_confidence_out_of_domain' END,
    CASE WHEN conf BETWEEN 0 AND 100 AND NOT conf BETWEEN 95 AND 100 THEN 'preferred_confidence_below_95' END, CASE WHEN want IS NOT NULL AND conf IS DISTINCT FROM want THEN 'preferred_flag_confidence_mapping_inconsistent' END) AS block_reasons FROM mm""")


def association(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.association(t.meas(), t.cat()).groupBy("association").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ent").alias("n_entities"), F.count("resolved").alias("n_resolved"))


SQL["association"] = measurement_sql("SELECT CASE WHEN ent = -999 THEN 'no_association_sentinel' WHEN known THEN 'associated' ELSE 'unresolved_identifier' END AS association, count(*) AS n, count(DISTINCT ent) AS n_entities, count(*) FILTER (ent <> -999 AND known) AS n_resolved FROM mm GROUP BY 1")


def preferred(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = M.preferred(M.in_catalog(t.meas(), t.cat()))
    return out.select("ent", "p_id", r6(F.col("p_z")).alias("p_z"), "p_flag", "p_conf", "tied", *joined("tied_ids"))


def _preferred_sql(source: str) -> str:
    return f"""SELECT ent, id AS p_id, z AS p_z, flag AS p_flag, conf AS p_conf, len(ties) > 1 AS tied, array_to_string(ties, ',') AS tied_ids
      FROM (SELECT *, row_number() OVER (PARTITION BY ent ORDER BY NOT coalesce(conf BETWEEN 0 AND 100, false), CASE WHEN conf BETWEEN 0 AND 100 THEN -conf ELSE 1 END, id) AS rn,
        list_sort(list(id) OVER (PARTITION BY ent, conf)) AS ties FROM {source} WHERE valid) WHERE rn = 1"""


SQL["preferred"] = measurement_sql(f"SELECT * REPLACE (round(p_z, 6) AS p_z) FROM ({_preferred_sql('am')})")


def conflicts(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = M.conflicts(M.in_catalog(t.meas(), t.cat()))
    return out.withColumn("span", r6(F.col("span")))


def _pairs(source: str) -> str:
    return f"SELECT l.ent, l.id AS left_id, r.id AS right_id, l.z AS left_z, r.z AS right_z, l.flag AS left_flag, r.flag AS right_flag, l.conf AS left_conf, r.conf AS right_conf, abs(l.z - r.z) AS difference, l.sec AND r.sec AS both_secure FROM {source} l JOIN {source} r ON l.ent = r.ent AND l.id < r.id AND l.valid AND r.valid AND abs(l.z - r.z) > 0.005"


SQL["conflicts"] = measurement_sql(f"""WITH p AS ({_pairs('am')}), f AS (SELECT ent, bool_or(both_secure) AS s, bool_or(NOT both_secure) AS o FROM p GROUP BY ent)
  SELECT ent, count(*) FILTER (valid) AS n_valid, count(*) FILTER (sec) AS n_secure, round(coalesce(max(z) FILTER (valid) - min(z) FILTER (valid), 0), 6) AS span, any_value(f.ent) IS NOT NULL AS any_conflict,
  coalesce(any_value(s), false) AS secure_conflict, coalesce(any_value(o), false) AS other_conflict FROM am LEFT JOIN f USING (ent) GROUP BY ent""".replace("WITH p", ", p", 1))  # fmt: skip


def witnesses(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    out = M.witnesses(M.in_catalog(t.meas_unique(), t.cat()))
    return out.withColumns({c: r6(F.col(c)) for c in ("left_z", "right_z", "difference")})


SQL["witnesses"] = measurement_sql(f"SELECT * REPLACE (round(left_z, 6) AS left_z, round(right_z, 6) AS right_z, round(difference, 6) AS difference) FROM ({_pairs('um')})")


def _splits(t: Tables) -> DataFrame:
    return S.hash_split(t.nation.select(F.col("n_name").alias("tile")), "tile", SALT, 4, 4)


def _summary(t: Tables) -> DataFrame:
    return M.with_split(M.source_summary(t.cat(), t.meas(), t.meas_unique()), _splits(t))


SUMMARY = ["ent", "tile", "class", "n_all", "n_valid_all", "n_secure", "n_broad", "n_unique", "p_id", "p_z", "p_flag", "p_conf", "tied", "p_secure", "unique_conflict", "secure_conflict", "other_disagreement", "label", "broad", "is_qso", "population_a", "population_b", "corroboration", "split", "eligible_primary", "eligible_validation"]


def source_summary(spark: SparkSession, d: str) -> DataFrame:
    out = _summary(Tables(spark, d))
    return out.select(*[r6(F.col(c)).alias(c) if c == "p_z" else F.col(c) for c in SUMMARY], *joined("tied_ids", "broad_ids", "exclusion"))


_SPLIT_SQL = f"SELECT tile, digest, CASE WHEN rn <= 4 THEN 'holdout' WHEN rn <= 8 THEN 'validation' ELSE 'development' END AS split FROM (SELECT DISTINCT n_name AS tile, sha256('{SALT}|' || n_name) AS digest, row_number() OVER (ORDER BY sha256('{SALT}|' || n_name), n_name) AS rn FROM nation)"
_SUMMARY_SQL = f"""WITH pa AS ({_pairs('am')}), ca AS (SELECT ent, bool_or(both_secure) AS sc, bool_or(NOT both_secure) AS oc FROM pa GROUP BY ent), cu AS (SELECT DISTINCT ent FROM ({_pairs('um')})),
 ga AS (SELECT ent, count(*) AS n_all, count(*) FILTER (valid) AS n_valid_all, count(*) FILTER (sec) AS n_secure, count(*) FILTER (valid AND flag IN (11, 12, 13, 14, 19)) AS n_broad, list_sort(list(id) FILTER (valid AND flag IN (11, 12, 13, 14, 19))) AS bids FROM am GROUP BY ent),
 gu AS (SELECT ent, count(*) AS n_unique FROM um GROUP BY ent), pr AS ({_preferred_sql('um')}), sp AS ({_SPLIT_SQL}),
 j AS (SELECT cat.id AS ent, cat.tile, class, coalesce(n_all, 0) AS n_all, coalesce(n_valid_all, 0) AS n_valid_all, coalesce(n_secure, 0) AS n_secure, coalesce(n_broad, 0) AS n_broad, coalesce(n_unique, 0) AS n_unique, p_id, p_z, p_flag, p_conf, coalesce(tied, false) AS tied, tied_ids, array_to_string(bids, ',') AS broad_ids,
   cu.ent IS NOT NULL AS unique_conflict, coalesce(sc, false) AS secure_conflict, coalesce(oc, false) AS other_disagreement, CASE WHEN class IS NULL THEN 'unknown_missing' WHEN class = 0 THEN 'galaxy' WHEN class = 1 THEN 'star' WHEN class = 2 THEN 'qso' ELSE 'unknown_unrecognized' END AS label,
   coalesce(n_broad, 0) > 0 AS broad, coalesce(class = 2, false) AS is_qso, coalesce(split, 'unassigned') AS split
   FROM cat LEFT JOIN ga ON ga.ent = cat.id LEFT JOIN gu ON gu.ent = cat.id LEFT JOIN pr ON pr.ent = cat.id LEFT JOIN ca ON ca.ent = cat.id LEFT JOIN cu ON cu.ent = cat.id LEFT JOIN sp ON sp.tile = cat.tile),
 k AS (SELECT *, coalesce({_SECURE.replace('z)', 'p_z)').replace('z >', 'p_z >').replace('flag', 'p_flag').replace('conf', 'p_conf')}, false) AS p_secure, n_all > 0 AND n_unique = 0 AS population_a, n_unique > 1 AS population_b,
   CASE WHEN n_secure = 0 THEN 'not_assessable' WHEN n_secure = 1 THEN 'singly_supported' WHEN secure_conflict THEN 'conflicting' ELSE 'multiply_supported' END AS corroboration,
   {_WANT.replace('flag', 'p_flag')} AS p_want FROM j),
 s AS (SELECT *, p_secure AND NOT unique_conflict AND NOT secure_conflict AND split <> 'unassigned' AND label = 'galaxy' AND NOT broad AS eligible_primary,
   p_secure AND NOT unique_conflict AND NOT secure_conflict AND split <> 'unassigned' AND label IN ('galaxy', 'qso') AND (broad OR is_qso) AS eligible_validation,
   p_id IS NOT NULL AND NOT p_secure AS blocked FROM k)""".replace("WITH pa", ", pa", 1)  # fmt: skip
SQL["source_summary"] = measurement_sql(_SUMMARY_SQL + f""" SELECT {', '.join('round(p_z, 6) + 0.0::DOUBLE AS p_z' if c == 'p_z' else c for c in SUMMARY)}, tied_ids, broad_ids,
 array_to_string(list_sort(list_filter([CASE WHEN n_all = 0 AND n_unique = 0 THEN 'no_association' END, CASE WHEN population_a THEN 'population_a_no_unique_entries' END, CASE WHEN p_id IS NULL AND n_unique > 0 THEN 'no_numeric_valid_unique_candidate' END,
  CASE WHEN blocked AND NOT coalesce(p_flag IN (3, 4, 13, 14), false) THEN 'preferred_flag_not_in_secure_domain' END, CASE WHEN blocked AND NOT coalesce(p_conf BETWEEN 0 AND 100, false) THEN 'preferred_confidence_out_of_domain' END,
  CASE WHEN blocked AND p_conf BETWEEN 0 AND 100 AND NOT p_conf BETWEEN 95 AND 100 THEN 'preferred_confidence_below_95' END, CASE WHEN blocked AND p_want IS NOT NULL AND p_conf IS DISTINCT FROM p_want THEN 'preferred_flag_confidence_mapping_inconsistent' END,
  CASE WHEN unique_conflict THEN 'unique_numeric_conflict' END, CASE WHEN secure_conflict THEN 'secure_all_conflict' END, CASE WHEN label = 'star' THEN 'photometric_type_stellar' END, CASE WHEN label LIKE 'unknown%' THEN 'photometric_type_unknown_or_missing' END,
  CASE WHEN broad THEN 'broad_line_evidence_present' END, CASE WHEN NOT broad AND NOT is_qso THEN 'no_broad_line_or_photometric_qso_evidence' END, CASE WHEN split = 'unassigned' THEN 'split_unassigned' END], lambda x: x IS NOT NULL)), ',') AS exclusion FROM s""")  # fmt: skip


def group_rules(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.group_rules(M.in_catalog(t.meas_unique(), t.cat()))


SQL["group_rules"] = measurement_sql(""", r AS (SELECT ent, rule, count(*) OVER (PARTITION BY ent, rule) AS n, CASE WHEN isfinite(z) AND z > lim THEN z END AS uz, coalesce(nullif(conf, 0), -1) AS cc, conf
   FROM um, (VALUES ('finite_gt_-90', -90.0::DOUBLE), ('positive', 0.0::DOUBLE)) v(rule, lim)),
 g AS (SELECT ent, rule, count(uz) AS u, max(uz) - min(uz) AS s, max(cc) FILTER (uz IS NOT NULL) AS top, list(conf) FILTER (uz IS NOT NULL) AS cs FROM r WHERE n > 1 GROUP BY ent, rule),
 l AS (SELECT *, CASE WHEN u = 0 THEN 'zero_usable' WHEN u = 1 THEN 'one_usable' WHEN s <= 0.005 THEN 'agreeing' ELSE 'disagreeing' END AS label FROM g)
 SELECT rule, label, count(*) AS n FROM l GROUP BY rule, label UNION ALL SELECT 'either', 'disagreeing_tied_top', count(DISTINCT ent) FROM l WHERE label = 'disagreeing' AND len(list_filter(cs, lambda c: c = top)) >= 2""")


def cascade(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.cascade(M.in_catalog(t.meas(), t.cat()), M.in_catalog(t.meas_unique(), t.cat()))


_STEPS = {"two_strong": "ns >= 2", "spanning": "span > 0.005", "one_unique": "nu = 1", "unique_strong": "us"}
SQL["cascade"] = measurement_sql(""", a AS (SELECT ent, count(*) FILTER (valid AND conf >= 95) AS ns, max(z) FILTER (valid AND conf >= 95) - min(z) FILTER (valid AND conf >= 95) AS span FROM am GROUP BY ent),
 u AS (SELECT ent, count(*) AS nu, bool_or(valid AND coalesce(conf >= 95, false)) AS us FROM um GROUP BY ent), x AS (SELECT * FROM a JOIN u USING (ent)) """ + " UNION ALL ".join(f"SELECT {i}::INT AS step, '{n}' AS name, count(*) FILTER ({' AND '.join([*_STEPS.values()][: i + 1])}) AS n FROM x" for i, n in enumerate(_STEPS)))  # fmt: skip


def usable_sources(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.usable_sources(M.in_catalog(t.meas(), t.cat())).withColumnRenamed("n_gt_-90", "n_gt_floor")


SQL["usable_sources"] = measurement_sql("SELECT count(DISTINCT CASE WHEN isfinite(z) AND z > -90 THEN ent END) AS n_gt_floor, count(DISTINCT CASE WHEN valid THEN ent END) AS n_positive, count(DISTINCT CASE WHEN valid AND conf >= 95 THEN ent END) AS n_positive_strong, count(*) FILTER (flag IN (13, 14) AND conf >= 95) AS n_entries_broad_strong FROM am")


def multiplicity(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.multiplicity(M.in_catalog(t.meas(), t.cat()), "ent")


SQL["multiplicity"] = measurement_sql("SELECT entries, count(*) AS sources FROM (SELECT ent, count(*) AS entries FROM am GROUP BY ent) GROUP BY entries")


def population_ab(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.populations(M.in_catalog(t.meas(), t.cat()), M.in_catalog(t.meas_unique(), t.cat()))


SQL["population_ab"] = measurement_sql(", u AS (SELECT ent, count(*) AS nu FROM um GROUP BY ent) SELECT count(DISTINCT ent) FILTER (nu IS NULL) AS a_sources, count(*) FILTER (nu IS NULL) AS a_entries, count(*) FILTER (nu IS NULL AND prio <> 0) AS a_nonzero_priority, count(DISTINCT ent) FILTER (nu > 1) AS b_sources, (SELECT coalesce(sum(nu), 0)::BIGINT FROM u WHERE nu > 1) AS b_entries FROM am LEFT JOIN u USING (ent)")


def distribution(spark: SparkSession, d: str) -> DataFrame:
    return M.distribution(Tables(spark, d).meas(), "flag")


SQL["distribution"] = measurement_sql("SELECT flag AS value, count(*) AS n, (SELECT count(*) FROM mm) AS total, true AS complete FROM mm GROUP BY flag")


def flag_bound(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.flag_table({"all": t.meas(), "unique": t.meas_unique()})


SQL["flag_bound"] = measurement_sql("SELECT s AS surface, flag, conf, count(*) AS n, coalesce(any_value(want) IS NOT NULL AND conf IS DISTINCT FROM any_value(want), false) AS inconsistent FROM (SELECT 'all' AS s, * FROM mm UNION ALL SELECT 'unique', * FROM mm WHERE prio = 1) GROUP BY s, flag, conf")


def crosstab(spark: SparkSession, d: str) -> DataFrame:
    return _summary(Tables(spark, d)).groupBy("label", "corroboration").agg(F.count(F.lit(1)).alias("n"), F.count_if("broad").alias("n_broad"))


SQL["crosstab"] = measurement_sql(_SUMMARY_SQL + " SELECT label, corroboration, count(*) AS n, count(*) FILTER (broad) AS n_broad FROM s GROUP BY label, corroboration")


def coverage_states(spark: SparkSession, d: str) -> DataFrame:
    return M.coverage_states(_summary(Tables(spark, d)))


_WHY = {
    "no_association": "n_all = 0 AND n_unique = 0", "population_a_no_unique_entries": "population_a", "no_numeric_valid_unique_candidate": "n_unique > 0 AND p_id IS NULL", "preferred_flag_not_in_secure_domain": "blocked AND NOT coalesce(p_flag IN (3, 4, 13, 14), false)",
    "preferred_confidence_below_95": "blocked AND coalesce(p_flag IN (3, 4, 13, 14), false) AND NOT coalesce(p_conf BETWEEN 95 AND 100, false)", "unique_numeric_conflict": "unique_conflict", "secure_all_conflict": "secure_conflict",
    "photometric_type_stellar": "label = 'star'", "photometric_type_unknown_or_missing": "label LIKE 'unknown%'", "broad_line_evidence_present": "broad", "no_broad_line_or_photometric_qso_evidence": "NOT broad AND NOT is_qso",
}
SQL["coverage_states"] = measurement_sql(_SUMMARY_SQL + " SELECT 'state' AS kind, CASE WHEN eligible_primary THEN 'primary_galaxy' WHEN eligible_validation THEN 'separate_validation' WHEN unique_conflict OR secure_conflict THEN 'conflict_vetoed' WHEN NOT p_secure THEN 'no_secure_preferred' ELSE 'classification_routed_out' END AS name, count(*) AS n FROM s GROUP BY 2 UNION ALL "
  + " UNION ALL ".join(f"SELECT 'reason', '{n}', count(*) FROM s WHERE {c} HAVING count(*) > 0" for n, c in _WHY.items()) + " UNION ALL SELECT 'violation', 'both_eligible', count(*) FILTER (eligible_primary AND eligible_validation) FROM s")


def coverage_tiles(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.coverage_by(t.cat(), t.nation.select(F.col("n_name").alias("tile")), "tile", "blend")


SQL["coverage_tiles"] = measurement_sql("SELECT g.tile, count(c.id) AS n, count(*) FILTER (blend) AS n_true, count(*) FILTER (NOT blend) AS n_false, count(*) FILTER (c.id IS NOT NULL AND blend IS NULL) AS n_missing FROM (SELECT n_name AS tile FROM nation UNION ALL SELECT '(other)') g LEFT JOIN (SELECT id, blend, coalesce(tile, '(other)') AS tile FROM cat) c ON c.tile = g.tile GROUP BY g.tile")

INF = float("inf")
MAG_EDGES, COLOR_EDGES = (-INF, -2.0, 0.0, 5.0, 10.0, 20.0, INF), (-INF, -0.5, -0.3, 0.0, 0.3, INF)


def binned_summary(spark: SparkSession, d: str) -> DataFrame:
    """Magnitude bins, and colour bins where both magnitudes lie inside the open display domain 0..30."""
    x, y = F.col("mag"), F.col("mag2")
    mag = F.when(x.isNull(), "native_missing").when(~finite(x), "non_finite").otherwise(binned(x, MAG_EDGES, edge_names(MAG_EDGES)))
    inside = (x > 0) & (x < 30) & (y > 0) & (y < 30)
    color = F.when(x.isNull() | y.isNull(), "native_missing_input").when(~finite(x) | ~finite(y), "non_finite_input").when(~inside, "not_evaluated_display_domain").otherwise(binned(F.round(x - y, 6), COLOR_EDGES, edge_names(COLOR_EDGES)))
    rows = Tables(spark, d).cat().select(F.inline(F.array(F.struct(F.lit("mag").alias("kind"), mag.alias("bin")), F.struct(F.lit("color").alias("kind"), color.alias("bin")))))
    return rows.groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"))


def _bins_sql(c: str, edges: tuple) -> str:
    names = edge_names(edges)
    return "CASE " + " ".join(f"WHEN {c} < {hi} THEN '{n}'" for hi, n in zip(edges[1:-1], names, strict=False)) + f" ELSE '{names[-1]}' END"


SQL["binned_summary"] = measurement_sql(f"""SELECT 'mag' AS kind, CASE WHEN mag IS NULL THEN 'native_missing' WHEN NOT isfinite(mag) THEN 'non_finite' ELSE {_bins_sql('mag', MAG_EDGES)} END AS bin, count(*) AS n FROM cat GROUP BY 2
 UNION ALL SELECT 'color', CASE WHEN mag IS NULL OR mag2 IS NULL THEN 'native_missing_input' WHEN NOT isfinite(mag) OR NOT isfinite(mag2) THEN 'non_finite_input' WHEN NOT (mag > 0 AND mag < 30 AND mag2 > 0 AND mag2 < 30) THEN 'not_evaluated_display_domain' ELSE {_bins_sql('round(mag - mag2, 6)', COLOR_EDGES)} END, count(*) FROM cat GROUP BY 2""")  # fmt: skip


def sensitivity(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return M.sensitivity(t.cat(), t.meas(), t.meas_unique(), _splits(t), VARIANTS)


_VAR = "(VALUES " + ", ".join(f"('{n}', {c}, {t or 'NULL'}::DOUBLE, {u or 'NULL'}::DOUBLE)" for n, c, t, u in VARIANTS) + ") v(variant, least, t, u)"
_APART = "CASE WHEN u IS NOT NULL THEN abs(l.z - r.z) / (1 + least(l.z, r.z)) > u ELSE abs(l.z - r.z) > coalesce(t, 0.005) END"
_SEC_V = "({0}.valid AND {0}.flag IN (3, 4, 13, 14) AND {0}.conf BETWEEN v.least AND 100 AND {0}.conf = {0}.want)"
SQL["sensitivity"] = measurement_sql(_SUMMARY_SQL + f""", vs AS (SELECT DISTINCT variant, l.ent FROM {_VAR}, am l JOIN am r ON l.ent = r.ent AND l.id < r.id WHERE {_SEC_V.format('l')} AND {_SEC_V.format('r')} AND {_APART}),
 vu AS (SELECT DISTINCT variant, l.ent FROM {_VAR}, um l JOIN um r ON l.ent = r.ent AND l.id < r.id WHERE l.valid AND r.valid AND {_APART}),
 b AS (SELECT s.*, v.variant, coalesce(isfinite(p_z) AND p_z > 0 AND p_flag IN (3, 4, 13, 14) AND p_conf BETWEEN v.least AND 100 AND p_conf = p_want, false) AS ns, EXISTS (SELECT 1 FROM vs WHERE vs.variant = v.variant AND vs.ent = s.ent) OR EXISTS (SELECT 1 FROM vu WHERE vu.variant = v.variant AND vu.ent = s.ent) AS nv, unique_conflict OR secure_conflict AS veto FROM s, {_VAR}),
 c AS (SELECT *, ns AND NOT nv AND split <> 'unassigned' AND label = 'galaxy' AND NOT broad AS np, ns AND NOT nv AND split <> 'unassigned' AND label IN ('galaxy', 'qso') AND (broad OR is_qso) AS nw,
   CASE WHEN p_secure AND NOT ns THEN 'preferred_entry_left_secure_domain' WHEN nv AND NOT veto THEN 'new_conflict_veto' WHEN veto AND NOT nv THEN 'conflict_veto_resolved_under_variant' WHEN ns AND NOT p_secure THEN 'preferred_entry_became_secure' ELSE 'other_recombination' END AS reason FROM b)
 SELECT variant, change, reason, count(*) AS n FROM (SELECT variant, 'gained_primary' AS change, reason FROM c WHERE np AND NOT eligible_primary UNION ALL SELECT variant, 'lost_primary', reason FROM c WHERE eligible_primary AND NOT np UNION ALL SELECT variant, 'total_primary', '-' FROM c WHERE np
   UNION ALL SELECT variant, 'gained_validation', reason FROM c WHERE nw AND NOT eligible_validation UNION ALL SELECT variant, 'lost_validation', reason FROM c WHERE eligible_validation AND NOT nw UNION ALL SELECT variant, 'total_validation', '-' FROM c WHERE nw) GROUP BY ALL""")  # fmt: skip


def confusion(spark: SparkSession, d: str) -> DataFrame:
    """Do measurements of high confidence (claim) reach the entities that secure measurements reach (truth)?"""
    t = Tables(spark, d)
    rows = M.in_catalog(t.meas(), t.cat())
    return M.confusion(t.cat().select(F.col("id").alias("ent")), rows.filter(M.secure()), t.meas().filter("conf >= 95 and z > 1"), "ent")


SQL["confusion"] = measurement_sql(""", x AS (SELECT id IN (SELECT ent FROM am WHERE sec) AS t, id IN (SELECT ent FROM meas WHERE conf >= 95 AND z > 1) AS c FROM cat),
 n AS (SELECT count(*) FILTER (t AND c) AS tp, count(*) FILTER (NOT t AND c) AS fp, count(*) FILTER (t AND NOT c) AS fn, count(*) FILTER (NOT t AND NOT c) AS tn FROM x) SELECT *, round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS precision, round(tp::DOUBLE / nullif(tp + fn, 0), 6) AS recall FROM n""")


def hash_split(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    s = _splits(t)
    counts = t.cat().groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    whole = S.split_digest(s, "tile").withColumn("k", F.lit(1))
    return s.join(counts, "tile", "left").withColumn("k", F.lit(1)).join(whole, "k").select("tile", "digest", "split", F.coalesce("n", F.lit(0)).alias("n"), "split_digest")


SQL["hash_split"] = measurement_sql(f", sp AS ({_SPLIT_SQL}) SELECT tile, digest, split, (SELECT count(*) FROM cat WHERE cat.tile = sp.tile) AS n, (SELECT sha256(string_agg(tile || '=' || split, chr(10) ORDER BY tile || '=' || split)) FROM sp) AS split_digest FROM sp")


def ranked_sample(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    s = S.ranked_sample(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 500, "seed-1")
    return s.withColumn("k", F.lit(1)).join(S.sample_digest(s, "o_orderkey").withColumn("k", F.lit(1)), "k").drop("k")


SQL["ranked_sample"] = "WITH s AS (SELECT o_orderkey, o_custkey, sha256('seed-1|' || o_orderkey::VARCHAR) AS sample_hash FROM orders ORDER BY 3, 1 LIMIT 500) SELECT *, (SELECT sha256(string_agg(o_orderkey::VARCHAR, chr(10) ORDER BY o_orderkey)) FROM s) AS sample_digest FROM s"

QUERIES = {f.__name__: f for f in (measurement_audit, association, preferred, conflicts, witnesses, source_summary, group_rules, cascade, usable_sources, multiplicity, population_ab, distribution, flag_bound, crosstab, coverage_states, coverage_tiles, binned_summary, sensitivity, confusion, hash_split, ranked_sample)}
