"""Scalar building blocks and the clinical rules made from them.

All of them are Catalyst expressions, so they run inside whole-stage codegen, are pushed through
projections, and work unchanged on streaming frames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.constants import RISK_LABELS


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ------------------------------------------------------------------ arithmetic


def safe_ratio(num, den, strict: bool = False) -> Column:
    """``num / den`` in doubles; NULL where ``den`` is not positive.

    ``strict`` keeps the plain division instead, which raises on zero under ANSI mode.
    """
    num, den = _column(num).cast("double"), _column(den).cast("double")
    return num / den if strict else F.when(den > 0, F.try_divide(num, den))


def difference(a, b) -> Column:
    return _column(a) - _column(b)


def round_half_up(value, digits: int = 0) -> Column:
    """Round by ``floor(x * 10^d + 0.5) / 10^d`` in doubles.

    ``round`` on doubles goes through decimals and differs between engines at ties; this form
    does not.
    """
    scale = F.lit(float(10**digits))
    return F.floor(_column(value).cast("double") * scale + F.lit(0.5)).cast("double") / scale


def clip(value, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL."""
    value = _column(value).cast("double")
    return F.when(value.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), value)))


def clip_round(value, lo: float, hi: float, digits: int = 0) -> Column:
    return round_half_up(clip(value, lo, hi), digits)


def clip_truncate(value, lo: float, hi: float) -> Column:
    """Clamp, then drop the fraction (toward zero) into an int."""
    clipped = clip(value, lo, hi)
    return F.when(clipped >= 0, F.floor(clipped)).otherwise(F.ceil(clipped)).cast("int")


# ------------------------------------------------------------------ buckets and scores


def bucketize(value, edges: list[float], labels: list[str], closed: str = "left", missing=None) -> Column:
    """Label a value by ascending edges.

    ``closed="left"``: ``len(edges) + 1`` labels; a value equal to an edge belongs above it, and
    anything that compares false to every edge (NULL included) takes the last label.
    ``closed="right"``: ``len(edges) - 1`` labels for (e0, e1], (e1, e2], ...; anything outside
    takes ``missing``.
    """
    value = _column(value)
    if closed == "left":
        if len(labels) != len(edges) + 1:
            raise ValueError("left-closed buckets need one label more than edges")
        pairs = [(value < F.lit(float(e)), name) for e, name in zip(edges, labels)]
        fallback = labels[-1]
    elif closed == "right":
        if len(labels) != len(edges) - 1:
            raise ValueError("right-closed buckets need one label less than edges")
        pairs = [(value <= F.lit(float(edges[0])), missing)]
        pairs += [(value <= F.lit(float(e)), name) for e, name in zip(edges[1:], labels)]
        fallback = missing
    else:
        raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
    chain = F
    for condition, name in pairs:
        chain = chain.when(condition, F.lit(name))
    return chain.otherwise(F.lit(fallback))


def flag_score(rules: list) -> Column:
    """Sum of points over rules; a rule is (condition, points) or a list of such, first match wins.

    A condition that is NULL adds nothing.
    """

    def one(rule) -> Column:
        tiers = rule if isinstance(rule, list) else [rule]
        chain = F
        for condition, points in tiers:
            chain = chain.when(condition, F.lit(points))
        return chain.otherwise(F.lit(0))

    return reduce(lambda a, b: a + b, [one(r) for r in rules])


def label_by_cutpoints(score, cutpoints: list[int], labels: list[str]) -> Column:
    """First label whose (inclusive) cutpoint is not exceeded, else the last one."""
    score = _column(score)
    chain = F
    for cut, name in zip(cutpoints, labels):
        chain = chain.when(score <= cut, F.lit(name))
    return chain.otherwise(F.lit(labels[-1]))


# ------------------------------------------------------------------ clinical rules
# Training and serving sides define two columns of the same name by different rules; both are
# kept, and callers say which one they mean.

# fixed values: rule edges, points and labels
BMI_EDGES_TRAIN = [18.5, 25.0, 30.0]
BMI_LABELS_TRAIN = ["UNDERWEIGHT", "NORMAL", "OVERWEIGHT", "OBESE"]
BMI_EDGES_SERVE = [0.0, 18.5, 25.0, 30.0, 35.0, 100.0]
BMI_LABELS_SERVE = ["UNDERWEIGHT", "NORMAL", "OVERWEIGHT", "OBESE", "SEVERELY_OBESE"]
RISK_CUTPOINTS = [2, 5, 8]


def _outside(name: str, lo: float, hi: float) -> Column:
    return (F.col(name) > hi) | (F.col(name) < lo)


def _at_least(name: str, *tiers: tuple) -> list:
    return [(F.col(name) >= edge, points) for edge, points in tiers]


def _vitals_rules() -> list:
    spo2 = F.col("oxygen_saturation")
    return [
        (_outside("heart_rate", 50, 100), 1),
        (_outside("systolic_bp", 90, 180), 2),
        [(spo2 < 92, 2), (spo2 < 95, 1)],
        (F.col("respiratory_rate") > 24, 1),
        (_outside("temperature", 36.0, 38.5), 1),
    ]


def bmi_category_train(bmi="bmi") -> Column:
    return bucketize(bmi, BMI_EDGES_TRAIN, BMI_LABELS_TRAIN, closed="left")


def bmi_category_serve(bmi="bmi") -> Column:
    return bucketize(bmi, BMI_EDGES_SERVE, BMI_LABELS_SERVE, closed="right", missing="nan")


def severity_train() -> Column:
    """Abnormal-vitals score of the training side, 0 to 7."""
    return flag_score(_vitals_rules())


def severity_serve() -> Column:
    """Abnormal-vitals score of the serving side: other thresholds, low and high pulse apart."""
    return flag_score(
        [
            (F.col("heart_rate") > 100, 1),
            (F.col("heart_rate") < 60, 1),
            (F.col("respiratory_rate") > 20, 1),
            (F.col("oxygen_saturation") < 94, 2),
            (F.col("temperature") > 38.0, 1),
            (F.col("systolic_bp") < 90, 2),
            (F.col("systolic_bp") > 180, 1),
        ]
    )


def risk_score() -> Column:
    """Additive rule score over age, vitals, labs and history (at most 18)."""
    creatinine = F.col("creatinine")
    return flag_score(
        [_at_least("age", (75, 2), (65, 1))]
        + _vitals_rules()
        + [
            (F.col("glucose_level") > 200, 1),
            [(creatinine > 2.0, 2), (creatinine > 1.5, 1)],
            (F.col("hemoglobin") < 10, 1),
            (_outside("wbc_count", 4, 12), 1),
            _at_least("comorbidity_count", (4, 2), (2, 1)),
            _at_least("previous_admissions", (3, 2), (1, 1)),
        ]
    )


def risk_label(score) -> Column:
    return label_by_cutpoints(score, RISK_CUTPOINTS, RISK_LABELS)


# ------------------------------------------------------------------ ids, hashes, stamps


def surrogate_id(keys: list, prefix: str, length: int = 32) -> Column:
    """Prefix plus the upper-case hex digits of the md5 of the keys, all 128 bits unless asked for fewer.

    A function of its keys, so a retried task writes the same id again.
    """
    text = F.concat_ws("|", *[_column(k).cast("string") for k in keys])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(text.cast("binary")), 1, length)))


def timestamp_text(ts) -> Column:
    return F.date_format(_column(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def record_hash(ts, payload) -> Column:
    """md5 of timestamp text followed by payload text."""
    return F.md5(F.concat(timestamp_text(ts), _column(payload)).cast("binary"))


def version_stamp(ts) -> Column:
    return F.date_format(_column(ts), "'v_'yyyyMMdd_HHmmss")


def hash_bucket(keys: list, buckets: int) -> Column:
    """Repeatable bucket 0..buckets-1 from the first 32 bits of the md5 of the keys."""
    text = F.concat_ws("|", *[_column(k).cast("string") for k in keys])
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def hash_uniform(keys: list) -> Column:
    """Repeatable uniform draw in [0, 1) from the md5 of the keys."""
    text = F.concat_ws("|", *[_column(k).cast("string") for k in keys])
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return head.cast("double") / F.lit(4294967296.0)


# ------------------------------------------------------------------ predicates


def time_range(ts, start, end) -> Column:
    """start <= ts < end, as plain comparisons that reach the scan."""
    ts = _column(ts)
    return (ts >= start) & (ts < end)


def in_list(value, items: list, negate: bool = False) -> Column:
    member = _column(value).isin(*items)
    return ~member if negate else member
