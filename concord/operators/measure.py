"""Repeat measurements of entities: quality predicates, preferred rows, conflicts, summaries.

Fixed values: the names of states and reasons.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import category, failed, finite, holds, in_domain, mapped, numeric_reason, reasons


@dataclass(frozen=True)
class Policy:
    """Thresholds and domains of the measurement policy (fixed values: the defaults)."""

    no_entity: int = -999
    measured: tuple[int, ...] = (1, 2, 3, 4, 9, 11, 12, 13, 14, 19)
    not_measured: tuple[int, ...] = (0, 10)
    confidence_of: Mapping[int, int] = field(default_factory=lambda: {1: 50, 2: 80, 3: 95, 4: 97, 9: 85})
    broad_offset: int = 10
    secure_flags: tuple[int, ...] = (3, 4, 13, 14)
    secure_from: int = 95
    secure_to: int = 100
    domain: tuple[int, int] = (0, 100)
    conflict: float = 0.005
    broad_flags: tuple[int, ...] = (11, 12, 13, 14, 19)
    galaxy: int = 0
    star: int = 1
    qso: int = 2


POLICY = Policy()


# ---- one measurement ---------------------------------------------------------
def valid_z() -> Column:
    return finite(F.col("z")) & holds(F.col("z") > 0)


def consistent(p: Policy = POLICY) -> Column:
    """Does the confidence equal the one that the flag stands for?  Null if the flag stands for none; a missing confidence does not."""
    want = mapped(F.col("flag"), p.confidence_of, p.broad_offset)
    return F.when(want.isNotNull(), F.col("conf").eqNullSafe(want))


def secure(p: Policy = POLICY, confidence_from: Column | None = None) -> Column:
    """Valid value, secure flag, confidence in the secure range and in line with the flag."""
    low = F.lit(p.secure_from) if confidence_from is None else confidence_from
    return valid_z() & holds(F.col("flag").isin(*p.secure_flags)) & holds((F.col("conf") >= low) & (F.col("conf") <= p.secure_to)) & holds(consistent(p))


def block_reasons(p: Policy = POLICY) -> Column:
    """All the conditions of a secure measurement that fail."""
    conf = F.col("conf")
    invalid = ~in_domain(conf, *p.domain)
    return failed({
        "preferred_z_not_numeric_valid": ~valid_z(), "preferred_flag_not_in_secure_domain": ~holds(F.col("flag").isin(*p.secure_flags)), "preferred_confidence_out_of_domain": invalid,
        "preferred_confidence_below_95": ~invalid & ~holds(conf.between(p.secure_from, p.secure_to)), "preferred_flag_confidence_mapping_inconsistent": holds(~consistent(p)),
    })


def association(meas: DataFrame, cat: DataFrame, p: Policy = POLICY) -> DataFrame:
    """Add association (none, associated, unresolved) and resolved id: measurements whose entity is known."""
    known = cat.select(F.col("id").alias("__known")).distinct()
    # without an entity there is nothing to look up: such rows are spread by their own id instead of meeting in one task
    key = F.when(F.col("ent").isNull() | (F.col("ent") == p.no_entity), -1 - F.abs("id")).otherwise(F.col("ent"))
    out = meas.withColumn("__key", key).join(known, F.col("__key") == F.col("__known"), "left")
    none = F.col("ent").isNull() | (F.col("ent") == p.no_entity)
    status = F.when(none, "no_association_sentinel").when(F.col("__known").isNotNull(), "associated").otherwise("unresolved_identifier")
    return out.withColumn("association", status).withColumn("resolved", F.when(~none, F.col("__known"))).drop("__key", "__known")


def audit(meas: DataFrame, cat: DataFrame, p: Policy = POLICY) -> DataFrame:
    """Every measurement with its native columns (native_*) and what is derived from them."""
    rows = association(meas, cat, p)
    flags = {"non_measured": p.not_measured, "recognized_measured": p.measured}
    native = [F.col(c).alias(f"native_{c}") for c in meas.columns if c != "id"]
    return rows.select(
        "id", *native, "association", "resolved", (F.col("prio") == 1).alias("is_unique_member"), valid_z().alias("valid_z"), numeric_reason(F.col("z")).alias("z_reason"),
        category(F.col("flag"), flags, "flag_missing", "unrecognized").alias("flag_category"), in_domain(F.col("conf"), *p.domain).alias("conf_in_domain"),
        consistent(p).alias("mapping_consistent"), secure(p).alias("secure"), block_reasons(p).alias("block_reasons"),
    )


# ---- one entity --------------------------------------------------------------
def in_catalog(meas: DataFrame, cat: DataFrame, p: Policy = POLICY) -> DataFrame:
    """The measurements of known entities, those only."""
    return meas.filter(F.col("ent").isNotNull() & (F.col("ent") != p.no_entity)).join(cat.select(F.col("id").alias("ent")), "ent", "left_semi")


def preferred(unique: DataFrame, p: Policy = POLICY) -> DataFrame:
    """ent, the preferred measurement (p_id, p_z, p_flag, p_conf), tied, tied_ids.

    Valid values only; the highest valid confidence wins, then the least id.
    An aggregate chooses the row; ties are the rows with the winner's
    confidence (null equals null), found by joining the winner back.
    """
    rows = unique.filter(valid_z())
    ok = in_domain(F.col("conf"), *p.domain)
    order = F.struct((~ok).alias("invalid"), F.when(ok, -F.col("conf")).otherwise(F.lit(1)).alias("rank"), F.col("id"))
    won = rows.groupBy("ent").agg(F.min_by(F.struct("id", "z", "flag", "conf"), order).alias("w"))
    won = won.select("ent", F.col("w.id").alias("p_id"), F.col("w.z").alias("p_z"), F.col("w.flag").alias("p_flag"), F.col("w.conf").alias("p_conf"))
    ties = rows.join(won.select("ent", "p_conf"), "ent").filter(F.col("conf").eqNullSafe(F.col("p_conf"))).groupBy("ent").agg(F.array_sort(F.collect_list("id")).alias("tied_ids"))
    return won.join(ties, "ent").withColumn("tied", F.size("tied_ids") > 1)


def _extremes(p: Policy) -> list[Column]:
    z, s = F.when(valid_z(), F.col("z")), secure(p)
    zs, zn = F.when(s, z), F.when(~s, z)
    return [F.count(z).alias("n_valid"), F.count(zs).alias("n_secure"), F.min(z).alias("lo"), F.max(z).alias("hi"), F.min(zs).alias("slo"), F.max(zs).alias("shi"), F.min(zn).alias("nlo"), F.max(zn).alias("nhi")]


def _conflict_flags(t: float) -> list[Column]:
    span = F.coalesce(F.col("hi") - F.col("lo"), F.lit(0.0))
    other = F.greatest(F.col("nhi") - F.col("lo"), F.col("hi") - F.col("nlo")) > t
    return [span.alias("span"), (span > t).alias("any_conflict"), holds(F.col("shi") - F.col("slo") > t).alias("secure_conflict"), holds(other).alias("other_conflict")]


def conflicts(meas: DataFrame, p: Policy = POLICY, threshold: float | None = None) -> DataFrame:
    """ent, n_valid, n_secure, span, any_conflict, secure_conflict, other_conflict by extremes alone.

    Some pair differs by more than t exactly if max - min does.  Some pair that
    is not secure on both sides does exactly if the not-secure extremes differ
    from the overall ones by more than t.
    """
    t = p.conflict if threshold is None else threshold
    return meas.groupBy("ent").agg(*_extremes(p)).select("ent", "n_valid", "n_secure", *_conflict_flags(t))


#: Rows of a unit of work on either side, when the pairs of one entity are formed.
UNIT_ROWS = 1000


def witnesses(meas: DataFrame, p: Policy = POLICY, both_secure: bool | None = None, unit: int = UNIT_ROWS) -> DataFrame:
    """The pairs of one entity that differ by more than the threshold; only entities in conflict are looked into.

    `both_secure`: True keeps pairs secure on both sides, False the others, None all.

    An entity of up to `unit` rows is a unit of work.  The values of a larger one
    are cut into buckets a little narrower than the threshold, so that no two
    values of a bucket conflict, and buckets into units: only units of different
    buckets meet, each two of them as a key of their own, so the pairs of one
    entity, however many rows it has, are formed by many tasks.
    """
    if p.conflict <= 0:
        raise ValueError("the threshold of a conflict must be positive")
    hit = {None: F.col("any_conflict"), True: F.col("secure_conflict"), False: F.col("other_conflict")}[both_secure]
    found = conflicts(meas, p).filter(hit).select("ent", (F.col("n_valid") > unit).alias("big"))
    at = F.col("z") / F.lit(p.conflict * (1 - 1e-9))
    # from 2^53 buckets on any two values conflict: each is its own
    bucket = F.when(~F.col("big"), F.lit(0.0)).when(at < float(1 << 53), at - at % 1).otherwise(-F.col("z"))
    rows = meas.filter(valid_z()).select("ent", "id", "z", "flag", "conf", secure(p).alias("sec")).join(found, "ent").withColumn("bucket", bucket)
    sizes = rows.groupBy("ent", "bucket", "big").agg(F.when(F.col("big"), F.ceil(F.count(F.lit(1)) / unit)).otherwise(F.lit(1)).cast("int").alias("parts"))
    rows = rows.drop("big").join(sizes.drop("big"), ["ent", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    units = sizes.select("ent", "big", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    one, two = (units.select("ent", *(["big"] if n == 1 else []), F.col("bucket").alias(f"b{n}"), F.col("part").alias(f"p{n}")) for n in (1, 2))
    pairs = one.join(two, "ent").filter((F.col("b1") < F.col("b2")) | ~F.col("big"))
    sides = []
    for n in (1, 2):
        cells = rows.select("ent", F.col("bucket").alias(f"b{n}"), F.col("part").alias(f"p{n}"), F.struct("id", "z", "flag", "conf", "sec").alias(f"r{n}"))
        sides.append(cells.join(pairs.select("ent", "b1", "p1", "b2", "p2", *(["big"] if n == 1 else [])), ["ent", f"b{n}", f"p{n}"]))
    met = sides[0].join(sides[1], ["ent", "b1", "p1", "b2", "p2"]).filter((F.col("r1.id") < F.col("r2.id")) | (F.col("big") & (F.col("r1.id") > F.col("r2.id"))))
    in_order = F.col("r1.id") < F.col("r2.id")
    met = met.select("ent", F.when(in_order, F.col("r1")).otherwise(F.col("r2")).alias("l"), F.when(in_order, F.col("r2")).otherwise(F.col("r1")).alias("r"))
    difference = F.abs(F.col("l.z") - F.col("r.z"))
    out = met.select("ent", *[F.col(f"{s}.{c}").alias(f"{side}_{c}") for s, side in (("l", "left"), ("r", "right")) for c in ("id", "z", "flag", "conf")], difference.alias("difference"), (F.col("l.sec") & F.col("r.sec")).alias("both_secure"))
    out = out.filter(F.col("difference") > p.conflict)
    return out if both_secure is None else out.filter(F.col("both_secure") == F.lit(both_secure))


def class_label(c: Column, p: Policy = POLICY) -> Column:
    return F.when(c.isNull(), "unknown_missing").when(c == p.galaxy, "galaxy").when(c == p.star, "star").when(c == p.qso, "qso").otherwise("unknown_unrecognized")


def source_summary(cat: DataFrame, meas: DataFrame, unique: DataFrame, p: Policy = POLICY) -> DataFrame:
    """One row for every catalogue entity, also those without a measurement: counts, preferred row, conflicts, class, reasons, eligibility.

    One aggregation over all measurements and one over the unique ones, each
    on the entity, joined to the catalogue.
    """
    every, few = in_catalog(meas, cat, p), in_catalog(unique, cat, p)
    broad = valid_z() & holds(F.col("flag").isin(*p.broad_flags))
    counted = every.groupBy("ent").agg(F.count(F.lit(1)).alias("n_all"), F.count_if(broad).alias("n_broad"), F.array_sort(F.collect_list(F.when(broad, F.col("id")))).alias("broad_ids"), *_extremes(p))
    per_all = counted.select("ent", "n_all", "n_broad", "broad_ids", F.col("n_valid").alias("n_valid_all"), "n_secure", *_conflict_flags(p.conflict)).drop("span", "any_conflict").withColumnRenamed("other_conflict", "other_disagreement")
    unique_counts = few.groupBy("ent").agg(F.count(F.lit(1)).alias("n_unique"), *_extremes(p))
    per_unique = unique_counts.select("ent", "n_unique", *_conflict_flags(p.conflict)).select("ent", "n_unique", F.col("any_conflict").alias("unique_conflict"))
    out = cat.withColumnRenamed("id", "ent")
    for part in (per_all, per_unique, preferred(few, p)):
        out = out.join(part, "ent", "left")
    for c in ("n_all", "n_valid_all", "n_secure", "n_broad", "n_unique"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    for c in ("secure_conflict", "other_disagreement", "unique_conflict", "tied"):
        out = out.withColumn(c, holds(F.col(c)))
    # the preferred row's own quality, from its copied columns
    out = out.withColumns({"z": F.col("p_z"), "flag": F.col("p_flag"), "conf": F.col("p_conf")})
    has = F.col("p_id").isNotNull()
    out = out.withColumns({"p_secure": has & secure(p), "blocks": F.when(has, block_reasons(p)), "label": class_label(F.col("class"), p), "broad": F.col("n_broad") > 0, "is_qso": holds(F.col("class") == p.qso)}).drop("z", "flag", "conf")
    corroboration = F.when(F.col("n_secure") == 0, "not_assessable").when(F.col("n_secure") == 1, "singly_supported").when(F.col("secure_conflict"), "conflicting").otherwise("multiply_supported")
    basis = has & F.col("p_secure") & ~F.col("unique_conflict") & ~F.col("secure_conflict")
    own = reasons({
        "no_association": (F.col("n_all") == 0) & (F.col("n_unique") == 0), "population_a_no_unique_entries": (F.col("n_all") > 0) & (F.col("n_unique") == 0), "no_numeric_valid_unique_candidate": ~has & (F.col("n_unique") > 0),
        "unique_numeric_conflict": F.col("unique_conflict"), "secure_all_conflict": F.col("secure_conflict"), "photometric_type_stellar": F.col("label") == "star", "photometric_type_unknown_or_missing": F.col("label").startswith("unknown"),
        "broad_line_evidence_present": F.col("broad"), "no_broad_line_or_photometric_qso_evidence": ~F.col("broad") & ~F.col("is_qso"),
    })
    blocked = F.when(has & ~F.col("p_secure"), F.col("blocks")).otherwise(F.array().cast("array<string>"))
    return out.withColumns({
        "population_a": (F.col("n_all") > 0) & (F.col("n_unique") == 0), "population_b": F.col("n_unique") > 1, "corroboration": corroboration,
        "basis_primary": basis & (F.col("label") == "galaxy") & ~F.col("broad"), "basis_validation": basis & F.col("label").isin("galaxy", "qso") & (F.col("broad") | F.col("is_qso")),
        "exclusion": F.array_sort(F.array_distinct(F.concat(own, blocked))),
    }).drop("blocks")


def with_split(summary: DataFrame, splits: DataFrame, unassigned: str = "unassigned") -> DataFrame:
    """Gate eligibility by the split of the tile; a missing or unknown tile is unassigned and says so among the reasons."""
    out = summary.join(splits.select("tile", "split"), "tile", "left").withColumn("split", F.coalesce("split", F.lit(unassigned)))
    ok = F.col("split") != unassigned
    reasons_ = F.when(ok, F.col("exclusion")).otherwise(F.array_sort(F.array_union("exclusion", F.array(F.lit("split_unassigned")))))
    return out.withColumns({"eligible_primary": F.col("basis_primary") & ok, "eligible_validation": F.col("basis_validation") & ok, "exclusion": reasons_})


# ---- counts over entities ----------------------------------------------------
RULES = {"finite_gt_-90": lambda z: finite(z) & (z > -90), "positive": lambda z: finite(z) & (z > 0)}


def group_rules(unique: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """rule, label, n: agreement of the entities with several unique measurements, under each rule of what is usable."""
    # counted by confidence first: an entity's rows are never gathered
    first, second = [F.count(F.lit(1)).alias("__n")], [F.sum("__n").alias("n")]
    level = F.coalesce(F.when(F.col("conf") != 0, F.col("conf")), F.lit(-1))
    for rule, usable in RULES.items():
        z = F.when(holds(usable(F.col("z"))), F.col("z"))
        first += [F.count(z).alias(f"u_{rule}"), F.min(z).alias(f"lo_{rule}"), F.max(z).alias(f"hi_{rule}")]
        at = F.struct(level.alias("conf"), F.when(level.eqNullSafe(F.col("conf")), F.col(f"u_{rule}")).otherwise(F.lit(0)).alias("n"))
        second += [F.sum(f"u_{rule}").alias(f"u_{rule}"), (F.max(f"hi_{rule}") - F.min(f"lo_{rule}")).alias(f"s_{rule}"), F.max(F.when(F.col(f"u_{rule}") > 0, at)).alias(f"t_{rule}")]
    groups = unique.groupBy("ent", "conf").agg(*first).groupBy("ent").agg(*second).filter("n > 1")
    label = lambda r: F.when(F.col(f"u_{r}") == 0, "zero_usable").when(F.col(f"u_{r}") == 1, "one_usable").when(F.col(f"s_{r}") <= tolerance, "agreeing").otherwise("disagreeing")
    tied = lambda r: (label(r) == "disagreeing") & (F.col(f"t_{r}.n") >= 2)
    long = groups.select("ent", F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), label(r).alias("label")) for r in RULES])))
    either = groups.filter(tied("finite_gt_-90") | tied("positive")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("either").alias("rule"), F.lit("disagreeing_tied_top").alias("label"), "n")
    return long.groupBy("rule", "label").agg(F.count(F.lit(1)).alias("n")).unionByName(either)


def cascade(every: DataFrame, unique: DataFrame, confidence: int = 95, t: float = 0.005) -> DataFrame:
    """step, n: entities with two strong measurements, of these spanning, with one unique measurement, which is strong itself."""
    strong = valid_z() & holds(F.col("conf") >= confidence)
    z = F.when(strong, F.col("z"))
    a = every.groupBy("ent").agg(F.count(z).alias("n_strong"), (F.max(z) - F.min(z)).alias("span"))
    u = unique.groupBy("ent").agg(F.count(F.lit(1)).alias("n_unique"), F.max(strong).alias("u_strong"))
    x, steps = a.join(u, "ent"), {"two_strong": F.col("n_strong") >= 2, "spanning": F.col("span") > t, "one_unique": F.col("n_unique") == 1, "unique_strong": F.col("u_strong")}
    so_far, sums = F.lit(True), []
    for i, (name, c) in enumerate(steps.items()):
        so_far = so_far & holds(c)
        sums.append(F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.count_if(so_far).alias("n")))
    return x.agg(F.array(*sums).alias("s")).select(F.inline("s"))


def populations(every: DataFrame, unique: DataFrame) -> DataFrame:
    """One row: entities (and measurements) only found among all, and with several unique measurements."""
    a = every.groupBy("ent").agg(F.count(F.lit(1)).alias("na"), F.count_if(holds(F.col("prio") != 0)).alias("np"))
    u = unique.groupBy("ent").agg(F.count(F.lit(1)).alias("nu"))
    x = a.join(u, "ent", "full_outer")
    only, many = F.col("nu").isNull(), F.col("nu") > 1
    return x.agg(F.count_if(only).alias("a_sources"), F.coalesce(F.sum(F.when(only, F.col("na"))), F.lit(0)).alias("a_entries"), F.coalesce(F.sum(F.when(only, F.col("np"))), F.lit(0)).alias("a_nonzero_priority"), F.count_if(many).alias("b_sources"), F.coalesce(F.sum(F.when(many, F.col("nu"))), F.lit(0)).alias("b_entries"))


def multiplicity(rows: DataFrame, key: str) -> DataFrame:
    """entries, sources: how many entities have how many rows."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("entries")).groupBy("entries").agg(F.count(F.lit(1)).alias("sources"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """value, n, total, complete: value counts, checked against an independent count of the rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("__k", F.lit(1))
    total = df.agg(F.count(F.lit(1)).alias("total")).withColumn("__k", F.lit(1))
    summed = counts.groupBy("__k").agg(F.sum("n").alias("__s"))
    return counts.join(F.broadcast(total), "__k").join(F.broadcast(summed), "__k").select("value", "n", "total", (F.col("__s") == F.col("total")).alias("complete"))


def confusion(rows: DataFrame, truth: DataFrame, claim: DataFrame, key: str) -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall of the claimed keys against the true ones."""
    t, c = truth.select(key).distinct().withColumn("__t", F.lit(True)), claim.select(key).distinct().withColumn("__c", F.lit(True))
    x = rows.select(key).join(t, key, "left").join(c, key, "left")
    is_t, is_c = holds(F.col("__t")), holds(F.col("__c"))
    n = x.agg(F.count_if(is_t & is_c).alias("tp"), F.count_if(~is_t & is_c).alias("fp"), F.count_if(is_t & ~is_c).alias("fn"), F.count_if(~is_t & ~is_c).alias("tn"))
    share = lambda a, b: F.round(F.try_divide(F.col(a), F.col(a) + F.col(b)), 6)
    return n.select("*", share("tp", "fp").alias("precision"), share("tp", "fn").alias("recall"))


def usable_sources(unique: DataFrame, confidence: int = 95) -> DataFrame:
    """One row: distinct entities with a usable measurement under three rules."""
    z, strong = F.col("z"), holds(F.col("conf") >= confidence)
    rules = {"n_gt_-90": holds(RULES["finite_gt_-90"](z)), "n_positive": holds(RULES["positive"](z)), "n_positive_strong": holds(RULES["positive"](z)) & strong}
    return unique.agg(*[F.count_distinct(F.when(c, F.col("ent"))).alias(n) for n, c in rules.items()], F.count_if(holds(F.col("flag").isin(13, 14)) & strong).alias("n_entries_broad_strong"))


def flag_table(surfaces: Mapping[str, DataFrame], p: Policy = POLICY) -> DataFrame:
    """surface, flag, conf, n, inconsistent: flags by confidence on each surface, and whether they disagree."""
    out = None
    for name, rows in surfaces.items():
        part = rows.groupBy("flag", "conf").agg(F.count(F.lit(1)).alias("n")).withColumn("inconsistent", holds(~consistent(p))).withColumn("surface", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def sensitivity(cat: DataFrame, meas: DataFrame, unique: DataFrame, splits: DataFrame, variants: Sequence[tuple[str, int, float | None, float | None]], p: Policy = POLICY) -> DataFrame:
    """variant, change, reason, n of the entities whose eligibility changes, and their totals, with one parameter changed.

    A variant is (name, least confidence, threshold, normalised threshold).
    The preferred row stays; the secure status and the conflicts are judged
    anew, all variants in one aggregation.
    """
    base = with_split(source_summary(cat, meas, unique, p), splits).select("ent", "p_id", "p_z", "p_flag", "p_conf", "label", "broad", "is_qso", "split", "eligible_primary", "eligible_validation", "p_secure", (F.col("unique_conflict") | F.col("secure_conflict")).alias("veto"))
    table = F.array(*[F.struct(F.lit(n).alias("variant"), F.lit(c).alias("least"), F.lit(t).cast("double").alias("t"), F.lit(u).cast("double").alias("u")) for n, c, t, u in variants])
    # the normalised difference, too, is largest between the extremes, as values are positive
    def apart(lo: Column, hi: Column) -> Column:
        return holds(F.when(F.col("u").isNotNull(), (hi - lo) / (1 + lo) > F.col("u")).otherwise(hi - lo > F.coalesce("t", F.lit(p.conflict))))

    z = F.col("z")
    a = in_catalog(meas, cat, p).select("*", F.inline(table)).withColumn("s", F.when(secure(p, F.col("least")), z)).groupBy("variant", "ent", "t", "u").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).select("variant", "ent", apart(F.col("lo"), F.col("hi")).alias("sc"))
    u = in_catalog(unique, cat, p).filter(valid_z()).select("*", F.inline(table)).groupBy("variant", "ent", "t", "u").agg(F.min("z").alias("lo"), F.max("z").alias("hi")).select("variant", "ent", apart(F.col("lo"), F.col("hi")).alias("uc"))
    x = base.select("*", F.inline(table)).join(a, ["variant", "ent"], "left").join(u, ["variant", "ent"], "left")
    x = x.withColumns({"z": F.col("p_z"), "flag": F.col("p_flag"), "conf": F.col("p_conf")}).withColumn("now_secure", F.col("p_id").isNotNull() & secure(p, F.col("least"))).withColumn("now_veto", holds(F.col("sc")) | holds(F.col("uc")))
    ok = F.col("now_secure") & ~F.col("now_veto") & (F.col("split") != "unassigned")
    x = x.withColumns({"now_primary": ok & (F.col("label") == "galaxy") & ~F.col("broad"), "now_validation": ok & F.col("label").isin("galaxy", "qso") & (F.col("broad") | F.col("is_qso"))})
    why = F.when(F.col("p_secure") & ~F.col("now_secure"), "preferred_entry_left_secure_domain").when(F.col("now_veto") & ~F.col("veto"), "new_conflict_veto").when(F.col("veto") & ~F.col("now_veto"), "conflict_veto_resolved_under_variant").when(F.col("now_secure") & ~F.col("p_secure"), "preferred_entry_became_secure").otherwise("other_recombination")
    changes = []
    for kind in ("primary", "validation"):
        was, now = F.col(f"eligible_{kind}"), F.col(f"now_{kind}")
        changes += [F.when(now & ~was, F.struct(F.lit(f"gained_{kind}").alias("change"), why.alias("reason"))), F.when(was & ~now, F.struct(F.lit(f"lost_{kind}").alias("change"), why.alias("reason"))), F.when(now, F.struct(F.lit(f"total_{kind}").alias("change"), F.lit("-").alias("reason")))]
    return x.select("variant", F.inline(F.array_compact(F.array(*changes)))).groupBy("variant", "change", "reason").agg(F.count(F.lit(1)).alias("n"))


# ---- coverage ----------------------------------------------------------------
def coverage_states(summary: DataFrame) -> DataFrame:
    """kind, name, n: exclusive states of all entities, overlapping reasons, and violations of exclusiveness."""
    veto = F.col("unique_conflict") | F.col("secure_conflict")
    state = F.when(F.col("eligible_primary"), "primary_galaxy").when(F.col("eligible_validation"), "separate_validation").when(veto, "conflict_vetoed").when(~F.col("p_secure"), "no_secure_preferred").otherwise("classification_routed_out")
    states = summary.groupBy(state.alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("state").alias("kind"), "name", "n")
    has, bad_flag = F.col("p_id").isNotNull() & ~F.col("p_secure"), ~holds(F.col("p_flag").isin(3, 4, 13, 14))
    found = failed({
        "no_association": (F.col("n_unique") == 0) & (F.col("n_all") == 0), "population_a_no_unique_entries": F.col("population_a"), "no_numeric_valid_unique_candidate": (F.col("n_unique") > 0) & F.col("p_id").isNull(),
        "preferred_flag_not_in_secure_domain": has & bad_flag, "preferred_confidence_below_95": has & ~bad_flag & ~in_domain(F.col("p_conf"), 95, 100), "unique_numeric_conflict": F.col("unique_conflict"), "secure_all_conflict": F.col("secure_conflict"),
        "photometric_type_stellar": F.col("label") == "star", "photometric_type_unknown_or_missing": F.col("label").startswith("unknown"), "broad_line_evidence_present": F.col("broad"), "no_broad_line_or_photometric_qso_evidence": ~F.col("broad") & ~F.col("is_qso"),
    })
    why = summary.select(F.explode(found).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).select(F.lit("reason").alias("kind"), "name", "n")
    broken = summary.agg(F.count_if(F.col("eligible_primary") & F.col("eligible_validation")).alias("n")).select(F.lit("violation").alias("kind"), F.lit("both_eligible").alias("name"), "n")
    return states.unionByName(why).unionByName(broken)


def coverage_by(df: DataFrame, domain: DataFrame, key: str, flag: str) -> DataFrame:
    """Every value of the domain with its rows and the true, false and missing counts of a boolean; other values count as (other)."""
    known = domain.select(key).distinct().withColumn("__d", F.lit(True))
    rows = df.join(known, key, "left").withColumn(key, F.when(holds(F.col("__d")), F.col(key)).otherwise("(other)"))
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(holds(F.col(flag))).alias("n_true"), F.count_if(holds(~F.col(flag))).alias("n_false"), F.count_if(F.col(flag).isNull()).alias("n_missing"))
    grid = known.select(key).unionByName(df.sparkSession.createDataFrame([("(other)",)], f"{key} string"))
    out = grid.join(counts, key, "left")
    return out.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "n_true", "n_false", "n_missing")])
