"""SQL that grows the same small forests as the binned engine: two levels per tree, every node split."""

from __future__ import annotations

VALUE = "CASE {f} WHEN 0 THEN q WHEN 1 THEN d ELSE t END"


def soft(x: str, by: str) -> str:
    return f"CASE WHEN {x} > {by} THEN {x} - {by} WHEN {x} < -{by} THEN {x} + {by} ELSE 0 END"


def objective(x: str, v: str, y: str, l1: float) -> str:
    return f"(0.5 * {v} * {x} * {x} - {x} * {y} + {l1} * abs({x}))"


def tree_ctes(k: int, source: str, label: str, l1: float, l2: float, levels: int = 2, min_sample: float = 5.0) -> str:
    """CTEs ``k_rows`` (rows with final ``node, w, rule, f0, f1``) and ``k_splits`` (one row per split).

    ``source`` has ``q, d, t`` and the columns to keep; nodes are numbered as in a heap.
    """
    parts = [f"t{k}_l0 AS (SELECT *, 0 AS node, CAST(0 AS DOUBLE) AS wt, '' AS rule, -1 AS f0, -1 AS f1 FROM {source})"]
    for lv in range(levels):
        c = f"t{k}_l{lv}"
        parts.append(
            f"{c}_h AS (SELECT node, f.feature, {VALUE.format(f='f.feature')} AS value, sum({label}) AS y, CAST(count(*) AS DOUBLE) AS h "
            f"FROM {c}, (VALUES (0), (1), (2)) f(feature) GROUP BY 1, 2, 3)"
        )
        parts.append(
            f"{c}_k AS (SELECT node, feature, value, sum(y) OVER w AS yl, sum(h) OVER w AS hl, sum(y) OVER p AS yt, sum(h) OVER p AS ht FROM {c}_h "
            "WINDOW w AS (PARTITION BY node, feature ORDER BY value), p AS (PARTITION BY node, feature))"
        )
        parts.append(
            f"{c}_v AS (SELECT *, yt - yl AS yr, ht - hl AS hr, hl + {l2} + 1e-10 AS vl, ht - hl + {l2} + 1e-10 AS vr, ht + {l2} + 1e-10 AS vt FROM {c}_k "
            f"WHERE hl < ht AND hl >= {min_sample} * ht / (ht + 1e-10) AND ht - hl >= {min_sample} * ht / (ht + 1e-10))"
        )
        parts.append(
            f"{c}_x AS (SELECT *, {soft('(yl / vl)', f'({l1} / vl)')} AS xl, {soft('(yr / vr)', f'({l1} / vr)')} AS xr, {soft('(yt / vt)', f'({l1} / vt)')} AS xt FROM {c}_v)"
        )
        parts.append(
            f"{c}_g AS (SELECT *, {objective('xt', 'vt', 'yt', l1)} - {objective('xl', 'vl', 'yl', l1)} - {objective('xr', 'vr', 'yr', l1)} AS gain FROM {c}_x)"
        )
        parts.append(
            f"{c}_b AS (SELECT b.*, 0.5 * (b.value + (SELECT min(v.value) FROM domain v WHERE v.feature = b.feature AND v.value > b.value)) AS cut FROM {c}_g b WHERE gain > 1e-6 "
            "QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, value) = 1)"
        )
        go_left = f"({VALUE.format(f='b.feature')}) <= b.value"
        sep = "''" if lv == 0 else "';'"
        keep = "b.feature AS f0, r.f1" if lv == 0 else "r.f0, coalesce(b.feature, -1) AS f1"
        if lv == 0:
            keep = "coalesce(b.feature, -1) AS f0, r.f1"
        parts.append(
            f"t{k}_l{lv + 1} AS (SELECT r.* EXCLUDE (node, wt, rule, f0, f1), CASE WHEN b.node IS NULL THEN r.node WHEN {go_left} THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node, "
            f"CASE WHEN b.node IS NULL THEN r.wt WHEN {go_left} THEN b.xl ELSE b.xr END AS wt, "
            f"CASE WHEN b.node IS NULL THEN r.rule ELSE r.rule || {sep} || CAST(b.feature AS VARCHAR) || CASE WHEN {go_left} THEN '<=' ELSE '>' END || CAST(round(b.cut, 5) AS VARCHAR) END AS rule, {keep} "
            f"FROM t{k}_l{lv} r LEFT JOIN t{k}_l{lv}_b b ON r.node = b.node)"
        )
    parts.append(f"t{k}_rows AS (SELECT * FROM t{k}_l{levels})")
    parts.append(
        f"t{k}_splits AS ("
        + " UNION ALL ".join(f"SELECT {lv} AS depth, node, feature, cut, gain FROM t{k}_l{lv}_b" for lv in range(levels))
        + ")"
    )
    return ", ".join(parts)


def domain(source: str) -> str:
    return f"domain AS (SELECT DISTINCT f.feature, {VALUE.format(f='f.feature')} AS value FROM {source}, (VALUES (0), (1), (2)) f(feature))"


def boosted(label: str, l1: float, l2: float, rate: float) -> str:
    """Two trees, the second on what the first leaves: ``base -> t0_rows -> s1 -> t1_rows``.

    The rows of ``t1_rows`` carry ``w0, rule0, a0, b0`` of tree 0 and ``wt, rule, f0, f1`` of tree 1.
    """
    source = f"base AS (SELECT q, d, t, {label} AS y FROM rows_)"
    second = (
        f"s1 AS (SELECT q, d, t, y, y - {rate} * wt AS res, node AS node0, {rate} * wt AS w0, rule AS rule0, f0 AS a0, f1 AS b0 FROM t0_rows)"
    )
    return ", ".join([source, domain("base"), tree_ctes(0, "base", "y", l1, l2), second, tree_ctes(1, "s1", "res", l1, l2)])


def leaves(rate: float) -> str:
    """``leaf`` (tree, rule, w, f0, f1, rows, label sum) and ``split`` (tree, feature, cut, gain)."""
    return f"""leaf AS (SELECT 0 AS tree, rule0 AS rule, max(w0) AS w, max(a0) AS f0, max(b0) AS f1, count(*) AS n, sum(y) AS ys FROM t1_rows GROUP BY rule0
 UNION ALL SELECT 1, rule, {rate} * max(wt), max(f0), max(f1), count(*), sum(y) FROM t1_rows GROUP BY rule),
 split AS (SELECT 0 AS tree, * FROM t0_splits UNION ALL SELECT 1, * FROM t1_splits),
 step AS (SELECT tree, rule, w, f0 AS feature FROM leaf WHERE f0 >= 0 UNION ALL SELECT tree, rule, w, f1 FROM leaf WHERE f1 >= 0)"""
