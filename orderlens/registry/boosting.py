"""Boosted trees of one split each, in SQL: the counterpart of training, tuning, scoring and judging a small model.

The first tree fits the labels (-1 and 1) by least squares, each later one what the logistic loss still pulls at, and adds
its two leaf means, times the rate, to the margin. Thresholds lie midway between neighbouring values.
"""

from __future__ import annotations

N_FEATURES = 9
_VECTOR = ", ".join(f"f{i}" for i in range(N_FEATURES))


def boosted(cells: str, rounds: int) -> str:
    """CTEs ``state_0`` to ``state_<rounds>`` (margins of all rows) and ``split_1`` to ``split_<rounds>``. ``cells`` selects
    ``cell, rate, order_id, label, is_train, fit, weight, f0`` to ``f8``: each cell is a training run, ``fit`` marks its rows."""
    steps = [f"state_0 AS (SELECT *, 2 * label - 1 AS y, 0.0::DOUBLE AS margin FROM ({cells}))"]
    for n in range(1, rounds + 1):
        before = f"state_{n - 1}"
        pull = "y::DOUBLE" if n == 1 else "4.0 * y / (1.0 + exp(2.0 * y * margin))"
        values = ", ".join(f"{{'feature': {i}, 'value': f{i}}}" for i in range(N_FEATURES))
        steps.append(f"""
        sums_{n} AS (
            SELECT cell, feature, value, sum(weight) AS n, sum(weight * pull) AS s
            FROM (SELECT cell, weight, {pull} AS pull, unnest([{values}], recursive := true) FROM {before} WHERE fit)
            GROUP BY cell, feature, value),
        cut_{n} AS (
            SELECT cell, feature, (value + lead(value) OVER w) / 2 AS threshold, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
                   sum(n) OVER p AS nt, sum(s) OVER p AS st
            FROM sums_{n}
            WINDOW w AS (PARTITION BY cell, feature ORDER BY value), p AS (PARTITION BY cell, feature)),
        split_{n} AS (
            SELECT cell, {n} AS round, feature, threshold, sl / nl AS low, (st - sl) / (nt - nl) AS high,
                   sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gained
            FROM cut_{n} WHERE threshold IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY cell ORDER BY
                round(sl * sl / nl + (st - sl) * (st - sl) / (nt - nl), 9) DESC, feature, threshold) = 1),
        state_{n} AS (
            SELECT b.* EXCLUDE (margin), margin + {"1.0" if n == 1 else "rate"}
                * CASE WHEN list_value({_VECTOR})[feature + 1] <= threshold THEN low ELSE high END AS margin
            FROM {before} b JOIN split_{n} USING (cell))""")
    return ",".join(steps)


PROBABILITY = "1.0 / (1.0 + exp(-2.0 * margin))"
LOSS = f"-ln(CASE WHEN label = 1 THEN {PROBABILITY} ELSE 1.0 - {PROBABILITY} END)"
