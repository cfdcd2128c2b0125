"""Ordered state machines over rule texts, and the second version of the tension outputs.

Fixed values: the names of states and reasons, and the domains in the rules.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import holds

#: What a rule or formula may call, and what Spark calls it.
FUNCTIONS = {"log10": "log10", "sqrt": "sqrt", "abs": "abs", "min": "least", "max": "greatest", "is_null": "isnull", "is_nan": "isnan"}
WORDS = {"and", "or", "not", "true", "false"}
CONSTANTS = {"ln10": "2.302585092994046D"}


def expression(text: str, columns: Sequence[str] | None = None) -> Column:
    """A formula or predicate as a Column.

    Names may hold dots (estimate.field); `^` is the power; only the functions
    of FUNCTIONS may be called, and with `columns` only these names used.
    """
    power = re.compile(r"([\w.`]+|\([^()]*\))\s*\^\s*([\w.]+)")
    while power.search(text):
        text = power.sub(r"power(\1, \2)", text)

    def name(m: re.Match) -> str:
        quoted, word, call = m[0], m[1], m[2]
        if word is None:
            return quoted
        if call:
            if word != "power" and word not in FUNCTIONS:
                raise ValueError(f"function {word} is not allowed")
            return FUNCTIONS.get(word, word) + "("
        if word.lower() in WORDS:
            return f"{word} "
        if word in CONSTANTS:
            return f"{CONSTANTS[word]} "
        if columns is not None and word not in columns:
            raise ValueError(f"unknown name {word}")
        return f"`{word}` "

    return F.expr(re.sub(r"'[^']*'|(?<![\w.`])([A-Za-z_][\w.]*)\s*(\(?)", name, text))


@dataclass(frozen=True)
class Machine:
    """Rules (state, reason, predicate) of which the first that holds decides.

    With a precondition that does not hold, the row is
    invalid_or_unsupported/parent_state_not_permitted.
    """

    name: str
    rules: tuple[tuple[str, str, str], ...]
    precondition: str | None = None


def run_machines(df: DataFrame, machines: Sequence[Machine]) -> DataFrame:
    """Add <name>_state and <name>_reason of each machine, in order: later ones may refer to the states of earlier ones."""
    out = df
    for m in machines:
        state, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
        for s, r, when in reversed(m.rules):
            hit = holds(expression(when))
            state, reason = F.when(hit, s).otherwise(state), F.when(hit, r).otherwise(reason)
        if m.precondition:
            ok = holds(expression(m.precondition))
            state, reason = F.when(ok, state).otherwise("invalid_or_unsupported"), F.when(ok, reason).otherwise("parent_state_not_permitted")
        out = out.withColumns({f"{m.name}_state": state, f"{m.name}_reason": reason})
    return out


def _scale_rules(low: str, high: str, b: str, err: str, own_error: bool) -> tuple:
    missing = f"is_null({low}) OR is_null({high})" + (f" OR is_null({err})" if own_error else "")
    negative = (("invalid_or_unsupported", "error_negative", f"{err} < 0"),) if own_error else ()
    return (
        ("missing", "missing_uncertainty_input", missing), ("invalid_or_unsupported", "quantile_order_violation", f"{high} < {low}"), *negative,
        ("approximation_out_of_domain", "log_error_approximation_domain_exceeded", f"({err} / {b}) > 0.3"), ("point_valid", "none", "true"),
    )


#: Fixed value: the reason of a logarithm outside the range that its estimator gives.
OUT_OF_DOMAIN = "lephare_value_out_of_domain"


def point_machine(name: str, a: str, b: str, err: str | None = None, out_of_domain: str = OUT_OF_DOMAIN) -> Machine:
    """Can log A and linear B be compared?  With `err`, B must also exceed its error."""
    rules = [
        ("missing", "missing_input", f"is_null({a}) OR is_null({b})"), ("invalid_or_unsupported", out_of_domain, f"{a} < -20.0 OR {a} > 15.0"),
        ("nonpositive_log_undefined", "exact_zero_native_value", f"{b} == 0"), ("nonpositive_log_undefined", "negative_native_value", f"{b} < 0"),
    ]
    if err:
        rules += [
            ("invalid_or_unsupported", "error_missing", f"is_null({err})"), ("invalid_or_unsupported", "error_negative", f"{err} < 0"),
            ("floor_or_censoring_suspected", "error_interval_spans_zero", f"{b} <= (1.0 * {err})"), ("upper_limit_supported", "bound_semantics_undeclared", "false"),
        ]
    return Machine(name, (*rules, ("point_comparable" if err else "point_valid", "none", "true")))


def scale_machine(name: str, parent: str, permitted: str, low: str, high: str, b: str, err: str, own_error: bool) -> Machine:
    """Can the sigmas be trusted?  Only asked where the parent machine found the point in order."""
    return Machine(name, _scale_rules(low, high, b, err, own_error), f"{parent}_state == '{permitted}'")


def ratio_machine(name: str, parents: str, c: str, out_of_domain: str = OUT_OF_DOMAIN) -> Machine:
    """A derived logarithmic ratio: defined where both parts are."""
    return Machine(name, (("missing", "missing_input", f"is_null({c})"), ("invalid_or_unsupported", out_of_domain, f"{c} < -20.0 OR {c} > 0.0"), ("point_valid", "none", "true")), parents)


def scored(df: DataFrame, name: str, a: str, low: str, high: str, b: str, err: str, expected: Column, floor: float, permitted: str, scale_gates: bool = True) -> DataFrame:
    """Add delta, residual, sigmas, score and score state of one quantity whose machines <name> and <name>_scale have run.

    The delta is given exactly where the point state permits it, the score
    where the scale state is point_valid too and the combined scale is not
    zero; nothing is replaced by an epsilon.  `scale_gates=False` scores
    wherever the point is permitted and the sigmas are defined.
    """
    ok = F.col(f"{name}_state") == permitted
    in_scale = F.col(f"{name}_scale_state") == "point_valid" if scale_gates else ok
    delta = F.when(ok, F.col(a) - F.log10(F.col(b)))
    s_a, s_b = (F.col(high) - F.col(low)) / 2, F.when(ok & in_scale, F.try_divide(F.col(err), F.col(b) * 2.302585092994046))
    combined = F.sqrt(s_a * s_a + s_b * s_b + F.lit(floor * floor))
    usable = holds(ok & in_scale & (combined >= 1e-12))
    state = F.when(usable, "point_valid").when(ok & in_scale, "zero_combined_scale").when(F.col(f"{name}_scale_state") == "approximation_out_of_domain", "approximation_out_of_domain").otherwise("unsupported_scale")
    return df.withColumns({
        f"delta_{name}": delta, f"residual_{name}": delta - expected, f"sigma_a_{name}": F.when(ok & in_scale, s_a), f"sigma_b_{name}": s_b,
        f"score_{name}": F.when(usable, F.try_divide(delta - expected, combined)), f"score_{name}_state": state,
    })
