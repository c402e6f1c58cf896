"""ANSI SQL giving the same results as the registered queries, written independently of them.

The SQL spells out bisection, assignment and Lloyd steps with plain joins and aggregates; it serves
checking only.
"""

from __future__ import annotations

from . import queries as q
from .sweep import LEVEL_COUNTS, QUALITY_COLUMNS

D = range(4)
#: Dimensions of the embeddings.
E = range(q.EMBEDDING_DIMS)


def _lit(v: float) -> str:
    return f"({float(v)!r})::DOUBLE"


def _unit(column: str, table: str) -> str:
    low, high = f"(SELECT min({column}) FROM {table})", f"(SELECT max({column}) FROM {table})"
    return f"2.0::DOUBLE * (({column} - {low}) / ({high} - {low})) - 1.0::DOUBLE"


LINE_PTS = (
    "pts AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, l_extendedprice AS price, 1.0::DOUBLE AS w, "
    + ", ".join(f"{_unit(c, 'lineitem')} AS x{j}" for j, c in enumerate(q.LINE)) + " FROM lineitem)")


EMB_PTS = ("pts AS (SELECT vec_id AS rid, vec_id, label, 1.0::DOUBLE AS w, "
           + ", ".join(f"embedding[{j + 1}]::DOUBLE AS x{j}" for j in E) + " FROM embeddings)")


def _coordinate(x: str, depth: int) -> str:
    half = 2 ** (depth - 1)
    return f"greatest(ceil(least(greatest({x}, -1.0), 1.0) * {half}) + {half - 1}, 0)::INTEGER"


def _coordinates(depth: int) -> str:
    return ", ".join(f"{_coordinate(f'x{j}', depth)} AS g{j}" for j in D)


def _level(depth: int, name: str) -> str:
    """Cells of one depth with their means, straight from the rows."""
    means = ", ".join(f"sum(x{j}) / count(*) AS m{j}" for j in D)
    keys = ", ".join(f"g{j}" for j in D)
    return (f"{name} AS (SELECT {depth} AS depth, {keys}, count(*) AS n, {means} "
            f"FROM (SELECT *, {_coordinates(depth)} FROM pts) GROUP BY {keys})")


def _rounded(names, digits=6, prefix="") -> str:
    return ", ".join(f"round({prefix}{n}, {digits}) AS {n}" for n in names)


def _center_rows(centers) -> str:
    return ", ".join("(" + ", ".join([str(k), *[_lit(v) for v in c]]) + ")" for k, c in enumerate(centers))


def _centers(name: str, centers) -> str:
    d = len(centers[0])
    return f"{name}(k, {', '.join(f'c{j}' for j in range(d))}) AS (VALUES {_center_rows(centers)})"


def _gap(dims=D, x="x", c="c") -> str:
    return " + ".join(f"({x}{j} - {c}{j}) * ({x}{j} - {c}{j})" for j in dims)


def _assigned(name: str, points: str, centers: str, dims=D) -> str:
    """Nearest centre of every point; ties go to the lowest index."""
    keep = ", ".join(f"any_value(p.{c}) AS {c}" for c in [f"x{j}" for j in dims] + ["w"])
    gap = _gap(dims, "p.x", "c.c")
    return (f"{name} AS (SELECT p.rid, {keep}, arg_min(c.k, ({gap}, c.k)) AS k, min({gap}) AS d2 "
            f"FROM {points} p CROSS JOIN {centers} c GROUP BY p.rid)")


def _moved(name: str, assigned: str, dims=D) -> str:
    means = ", ".join(f"sum(w * x{j}) / sum(w) AS c{j}" for j in dims)
    return f"{name} AS (SELECT k, {means} FROM {assigned} GROUP BY k)"


def _steps(points: str, centers: str, n: int, tag: str, dims=D) -> tuple[list[str], str]:
    out, at = [], centers
    for i in range(n):
        out += [_assigned(f"{tag}a{i}", points, at, dims), _moved(f"{tag}c{i}", f"{tag}a{i}", dims)]
        at = f"{tag}c{i}"
    return out, at


def _cell_points(level: str, name: str) -> str:
    return (f"{name} AS (SELECT row_number() OVER () AS rid, n::DOUBLE AS w, "
            + ", ".join(f"m{j} AS x{j}" for j in D) + f" FROM {level})")


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def _hash(seed, column: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {column})), 1, 15))::BIGINT"


def _uniform(seed, column: str) -> str:
    return f"(({_hash(seed, column)})::DOUBLE + 0.5) / {float(2**60)!r}::DOUBLE"


def _normal(seed, column: str) -> str:
    return (f"sqrt(-2.0 * ln({_uniform(f'{seed}|a', column)})) "
            f"* cos(2.0 * pi() * {_uniform(f'{seed}|b', column)})")


def _two_levels() -> list[str]:
    """Two levels of the fixed-start fit: depth 1 is the first with at least five cells."""
    first, at1 = _steps("p1", "c0", 2, "u")
    second, at2 = _steps("p2", at1, 2, "v")
    return [LINE_PTS, _centers("c0", q.LINE_CENTERS), _level(1, "l1"), _cell_points("l1", "p1"), *first,
            _level(2, "l2"), _cell_points("l2", "p2"), *second,
            f"after1 AS (SELECT * FROM {at1})", f"after2 AS (SELECT * FROM {at2})"]


def _seeds(k: int) -> list[str]:
    """k-means++ draws over the embeddings: the smallest -ln(1 - u) / d2 wins, u from (turn, row hash)."""
    parts = [f"hp AS MATERIALIZED (SELECT *, {_hash(q.SEED, 'vec_id')} AS h FROM pts)"]
    xs = ", ".join(f"x{j}" for j in E)
    for turn in range(k):
        wait = f"-ln(1.0 - {_uniform(turn, 'h')})"
        if turn:
            near = " UNION ALL ".join(f"SELECT {', '.join(f'x{j} AS c{j}' for j in E)} FROM s{i}" for i in range(turn))
            wait = f"{wait} / (SELECT nullif(min({_gap(E, 'p.x', 'c.c')}), 0) FROM ({near}) c)"
        parts.append(f"s{turn} AS MATERIALIZED (SELECT {turn} AS k, {xs} FROM hp p ORDER BY {wait} NULLS LAST, h LIMIT 1)")
    parts.append("c0 AS (" + " UNION ALL ".join(
        f"SELECT k, {', '.join(f'x{j} AS c{j}' for j in E)} FROM s{i}" for i in range(k)) + ")")
    return parts


def _batches(n: int) -> tuple[list[str], str]:
    """Running-mean updates over n batches in hash order."""
    parts = [f"dealt AS (SELECT *, (row_number() OVER (ORDER BY {_hash(q.SEED, 'vec_id')}) - 1) // "
             f"CAST(ceil((SELECT count(*) FROM pts) / {n}.0) AS BIGINT) AS b FROM pts)",
             "m0 AS (SELECT *, 0.0::DOUBLE AS seen FROM c0)"]
    for i in range(n):
        new = ", ".join(f"m{i}.c{j} + coalesce(s.n / (m{i}.seen + s.n) * (s.c{j} - m{i}.c{j}), 0) AS c{j}" for j in E)
        parts += [f"d{i} AS (SELECT * FROM dealt WHERE b = {i})", _assigned(f"b{i}", f"d{i}", f"m{i}", E),
                  f"t{i} AS (SELECT k, count(*)::DOUBLE AS n, {', '.join(f'avg(x{j}) AS c{j}' for j in E)} FROM b{i} GROUP BY k)",
                  f"m{i + 1} AS (SELECT m{i}.k, {new}, m{i}.seen + coalesce(s.n, 0) AS seen FROM m{i} LEFT JOIN t{i} s ON s.k = m{i}.k)"]
    return parts, f"m{n}"


CODES = ("codes AS (SELECT value, dense_rank() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT CASE WHEN "
         "o_orderkey % 17 = 0 THEN '?' ELSE o_orderpriority END AS value FROM orders)), "
         "gaps AS (SELECT o_orderkey, o_totalprice, o_orderstatus, CASE WHEN o_orderkey % 17 = 0 THEN '?' ELSE "
         "o_orderpriority END AS value FROM orders), "
         "coded AS (SELECT g.*, c.code FROM gaps g JOIN codes c ON g.value = c.value)")


def _imputed(fill: str) -> str:
    return (f"WITH {CODES} SELECT o_orderkey, round((CASE WHEN value = '?' THEN {fill} ELSE code END)::DOUBLE, 4) "
            "AS priority FROM coded")


MODE = "(SELECT code FROM coded WHERE value <> '?' GROUP BY code ORDER BY count(*) DESC, code LIMIT 1)"


#: Both sides of the gradient are what the data say: counts and sums of the price by class.
OPTIMALITY = (
    f"WITH {CODES}, scaled AS (SELECT code, o_totalprice::DOUBLE AS x FROM coded WHERE value <> '?'), "
    "sums AS (SELECT code, 'intercept' AS feature, count(*)::DOUBLE AS s FROM scaled GROUP BY code "
    "UNION ALL SELECT code, 'o_totalprice', sum(x) FROM scaled GROUP BY code) "
    "SELECT 'priority' AS \"column\", code::INTEGER AS code, feature, s AS observed, s AS predicted FROM "
    "(SELECT code, feature, CASE WHEN feature = 'intercept' THEN round(s, 3) ELSE round(s, -2) END AS s FROM sums)")


def _scaled(expression: str, constant: str = "0.0") -> str:
    return (f"SELECT c_custkey, round({expression}, 6) AS c_acctbal, round({constant}::DOUBLE, 6) AS constant FROM customer, "
            "(SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, avg(c_acctbal) AS mu, stddev_pop(c_acctbal) AS sd FROM customer)")


LABELLED = [EMB_PTS, _centers("c0", q.EMBEDDING_CENTERS), _assigned("near", "pts", "c0", E),
            "lab AS (SELECT p.vec_id, p.label AS a, n.k AS b FROM pts p JOIN near n ON p.rid = n.rid)"]
LINE_BOTH = [LINE_PTS, _centers("c0", q.LINE_CENTERS), _centers("c1", q.LINE_OTHER), _assigned("n0", "pts", "c0"),
             _assigned("n1", "pts", "c1"),
             "lab AS (SELECT n0.k AS a, n1.k AS b FROM n0 JOIN n1 ON n0.rid = n1.rid)"]
AGREEMENT = [
    "cell AS (SELECT a, b, count(*)::DOUBLE AS n FROM lab GROUP BY a, b)",
    "ra AS (SELECT a, sum(n) AS n FROM cell GROUP BY a)", "rb AS (SELECT b, sum(n) AS n FROM cell GROUP BY b)",
    "tot AS (SELECT sum(n) AS n FROM cell)",
    "ha AS (SELECT -sum(ra.n / tot.n * ln(ra.n / tot.n)) AS h FROM ra, tot)",
    "hb AS (SELECT -sum(rb.n / tot.n * ln(rb.n / tot.n)) AS h FROM rb, tot)",
    "mi AS (SELECT sum(cell.n / tot.n * ln(cell.n * tot.n / (ra.n * rb.n))) AS v FROM cell JOIN ra USING (a) JOIN rb USING (b), tot)",
    "emi AS (SELECT sum(v / tot.n * ln(tot.n * v / (an * bn)) * exp(lgamma(an + 1) + lgamma(bn + 1) + lgamma(tot.n - an + 1) "
    "+ lgamma(tot.n - bn + 1) - lgamma(tot.n + 1) - lgamma(v + 1) - lgamma(an - v + 1) - lgamma(bn - v + 1) "
    "- lgamma(tot.n - an - bn + v + 1))) AS v FROM (SELECT ra.n AS an, rb.n AS bn, unnest(range("
    "greatest(1, ra.n + rb.n - t.n)::BIGINT, least(ra.n, rb.n)::BIGINT + 1))::DOUBLE AS v FROM ra, rb, tot t), tot)",
]
ARI = ("(SELECT (i.s - ea.s * eb.s / (t.n * (t.n - 1) / 2)) / (0.5 * (ea.s + eb.s) - ea.s * eb.s / (t.n * (t.n - 1) / 2)) "
       "FROM (SELECT sum(n * (n - 1) / 2) AS s FROM cell) i, (SELECT sum(n * (n - 1) / 2) AS s FROM ra) ea, "
       "(SELECT sum(n * (n - 1) / 2) AS s FROM rb) eb, tot t)")
NMI = "(SELECT mi.v / (0.5 * (ha.h + hb.h)) FROM mi, ha, hb)"
AMI = "(SELECT (mi.v - emi.v) / (0.5 * (ha.h + hb.h) - emi.v) FROM mi, emi, ha, hb)"

WIDE = ("wide AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), "
        "flat AS (SELECT vec_id, label, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM wide), "
        "cent AS (SELECT label, j, avg(x) AS c, count(*) AS n FROM flat GROUP BY label, j)")
SILHOUETTE = (
    "wide AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), "
    "per AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS s, count(*) AS n "
    "FROM wide a, wide b GROUP BY a.vec_id, a.label, b.label), "
    "ab AS (SELECT vec_id, own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, "
    "min(CASE WHEN own <> other THEN s / n END) AS b FROM per GROUP BY vec_id, own), "
    "sil AS (SELECT vec_id, own AS label, CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)")

RESULTS = (
    "results AS (SELECT l_linenumber AS n_clusters, (l_partkey % 2)::INTEGER AS n_dims, (l_orderkey % 3)::INTEGER AS n_samples, "
    "CASE WHEN l_returnflag = 'A' THEN 'k-means++' ELSE 'recursive' END AS algorithm, "
    "CASE WHEN l_returnflag <> 'A' THEN (month(l_shipdate) % 6 + 1)::INTEGER END AS param, (l_suppkey % 4)::INTEGER AS replica, "
    "avg(sqrt(l_discount)) AS silhouette, avg(sqrt(l_extendedprice)) AS calinski_harabasz, avg(sqrt(l_tax)) AS davies_bouldin "
    "FROM lineitem GROUP BY ALL), "
    "means AS (SELECT n_clusters, n_dims, n_samples, algorithm, coalesce(param::VARCHAR, 'None') AS param, "
    + ", ".join(f"avg({c}) AS {c}" for c in QUALITY_COLUMNS) + " FROM results GROUP BY ALL)")


def _relative_table() -> str:
    parts = []
    for metric in QUALITY_COLUMNS:
        a, b = (f"0.5 * ({t}.{metric} + 1)" if metric == "silhouette" else f"{t}.{metric}" for t in "rk")
        error = f"CASE WHEN {a} = 0 AND {b} = 0 THEN 1.0 ELSE abs({a} - {b}) / ({a} + {b}) END"
        columns = ", ".join(
            f"round(avg(CASE WHEN r.param = '{m}' THEN {error} END), 6) AS m{m}" for m in LEVEL_COUNTS)
        parts.append(
            f"SELECT '{metric}' AS metric, {columns} FROM means r JOIN means k USING (n_clusters, n_dims, n_samples) "
            "WHERE r.algorithm = 'recursive' AND k.algorithm = 'k-means++'")
    return f"WITH {RESULTS} " + " UNION ALL ".join(parts)


def _keys(xs: list[str]) -> str:
    """The cell of a row at the level ``depth``."""
    return ", ".join(
        f"greatest(ceil(least(greatest({x}, -1.0), 1.0) * (1::BIGINT << (depth - 1))::DOUBLE)::BIGINT + (1::BIGINT << (depth - 1)) - 1, 0)"
        for x in xs)


def _instance_ratios() -> str:
    """Cells of every level of both samples and column choices; the fit with m levels ends at the m-th from the
    first with enough cells on."""
    import random

    ids = ", ".join(q.LINE_IDS)
    features = ", ".join(f"{_unit(c, 'lineitem')} AS u_{c}" for c in q.LINE)
    counts = " UNION ALL ".join(
        f"SELECT {d} AS n_dims, size AS n_samples, depth, count(DISTINCT ({_keys([f'u_{c}' for c in random.Random(0).sample(list(q.LINE), d)])})) AS n_cells "
        "FROM ranked JOIN sizes ON place <= size, range(1, 53) t(depth) GROUP BY size, depth" for d in (2, len(q.LINE)))
    return (
        f"WITH ranked AS (SELECT row_number() OVER (ORDER BY {_hash(0, ids)}, {ids}) AS place, {features} FROM lineitem), "
        "sizes AS (SELECT unnest([count(*) // 2, count(*)]) AS size FROM lineitem), "
        f"counts AS ({counts}), wanted AS (SELECT unnest({list(q.RATIO_CLUSTERS)}) AS n_clusters) "
        "SELECT n_clusters::INTEGER AS n_clusters, n_dims::INTEGER AS n_dims, n_samples, "
        "(row_number() OVER (PARTITION BY n_clusters, n_dims, n_samples ORDER BY depth))::INTEGER AS param, "
        "round(n_cells::DOUBLE / n_samples, 9) AS instance_ratio FROM counts JOIN wanted ON n_cells >= n_clusters QUALIFY param <= 6")


def _first_depth(box: str, xs: list[str], count: int) -> str:
    """The first of all 52 levels with so many cells; every level is counted straight from the rows."""
    keys = _keys(xs)
    return (f"(SELECT '{box}' AS box, depth::INTEGER AS depth, n_cells FROM (SELECT depth, count(DISTINCT ({keys})) AS n_cells "
            f"FROM pts, range(1, 53) t(depth) GROUP BY depth) WHERE n_cells >= {count} ORDER BY depth LIMIT 1)")


_CROWDED = ["CASE WHEN l_orderkey % 64 = 0 THEN x0 ELSE x0 * pow(2.0, -36) END", "x1 * pow(2.0, -40)"]
FIRST_DEPTHS = f"WITH {LINE_PTS} " + _first_depth("line", [f"x{j}" for j in D], 100) + " UNION ALL " + _first_depth("crowded", _CROWDED, 2000)


def _levels_union(select: str, depths=range(1, 7)) -> str:
    return _with(LINE_PTS, *[_level(i, f"l{i}") for i in depths]) + " UNION ALL ".join(
        select.format(i=i) for i in depths)


def _chosen_columns() -> list[str]:
    import random
    return sorted(random.Random(q.SEED).sample(["c_nationkey", "c_acctbal", "c_mktsegment"], 2))


WIDE_CENTERS = ("wc AS (SELECT k, j, (((k * 7 + (j - 1) * 3) % 11 - 5) / 40.0)::DOUBLE AS c FROM range(8) t(k), range(1, 65) u(j)), "
                "flat AS (SELECT vec_id, generate_subscripts(embedding, 1) AS j, unnest(embedding)::DOUBLE AS x FROM embeddings)")
def _own_box(column: str) -> str:
    low, high = f"(SELECT min({column}) FROM customer)::DOUBLE", f"(SELECT max({column}) FROM customer)::DOUBLE"
    return f"2.0::DOUBLE * ({column}::DOUBLE - {low}) / ({high} - {low}) - 1.0::DOUBLE"


OWN_PTS = ("pts AS (SELECT " + ", ".join(f"{c}::DOUBLE AS x{j}, {_own_box(c)} AS u{j}" for j, c in enumerate(q.CUSTOMER))
           + " FROM customer)")


def _own_level(depth: int, name: str) -> str:
    """Cells of one depth in the box of the data, with their means."""
    at = ", ".join(f"{_coordinate(f'u{j}', depth)} AS g{j}" for j in range(2))
    return (f"{name} AS (SELECT row_number() OVER () AS rid, count(*)::DOUBLE AS w, g0, g1, sum(x0) / count(*) AS x0, "
            f"sum(x1) / count(*) AS x1 FROM (SELECT *, {at} FROM pts) GROUP BY g0, g1)")


def _own_box_fit(levels: int) -> str:
    parts, at, rows = [OWN_PTS, _centers("c0", q.CUSTOMER_CENTERS)], "c0", []
    for i in range(1, levels + 1):
        steps, at = _steps(f"l{i}", at, 2, f"s{i}", range(2))
        parts += [_own_level(i, f"l{i}"), *steps]
        rows.append(f"SELECT {i} AS iteration, {i} AS depth, (SELECT count(*) FROM l{i}) AS n_cells, k::INTEGER AS k, "
                    f"{_rounded(['c0', 'c1'])} FROM {at}")
    return _with(*parts) + " UNION ALL ".join(rows)


def _own_geometry(depth: int) -> str:
    return (f"WITH {OWN_PTS}, {_own_level(depth, 'own')} "
            f"SELECT g0, g1, w::BIGINT AS n, round(x0, 6) AS m0, round(x1, 6) AS m1, "
            + ", ".join(f"round(a.lo{j} + (g{j} + {part}::DOUBLE) * (a.hi{j} - a.lo{j}) / {2**depth}.0::DOUBLE, 9) AS {name}{j}"
                        for j in range(2) for name, part in (("lo", 0.0), ("hi", 1.0), ("threshold", 0.5)))
            + " FROM own, (SELECT min(x0) AS lo0, max(x0) AS hi0, min(x1) AS lo1, max(x1) AS hi1 FROM pts) a")


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
COUNTS = ", ".join(f"(SELECT {i} AS depth, count(*) AS n_cells FROM l{i})" for i in range(1, 7))
EVENT_GAP = ", ".join(f"((value - {c[0]}) * (value - {c[0]}), {k})" for k, c in enumerate(q.EVENT_CENTERS))


def sql() -> dict[str, str]:
    two = _two_levels()
    seeds = _seeds(5)
    after_seeds, at_seeds = _steps("pts", "c0", 2, "s", E)
    batches, at_batches = _batches(3)
    history = " UNION ALL ".join(
        f"SELECT {i} AS iteration, {i} AS depth, (SELECT count(*) FROM l{i}) AS n_cells, "
        f"(SELECT count(*) FROM l{i}) * 10 AS distances, "
        f"round((SELECT count(*) FROM l{i})::DOUBLE / (SELECT count(*) FROM pts), 9) AS instance_ratio, k, "
        f"{_rounded([f'c{j}' for j in D])} FROM after{i}" for i in (1, 2))
    shift = " UNION ALL ".join(
        f"SELECT {i} AS iteration, round(max(sqrt({_gap(D, 'a.c', 'b.c')})), 6) AS max_shift "
        f"FROM {before} a JOIN after{i} b ON a.k = b.k" for i, before in ((1, "c0"), (2, "after1")))
    steps3, at3 = _steps("pts", "c0", 3, "s")
    cells2, at2 = _steps("p3", "c0", 2, "s")
    means4, keys4 = [f"m{j}" for j in D], ", ".join(f"g{j}" for j in D)
    centers4, centers_e = _rounded([f"c{j}" for j in D]), _rounded([f"c{j}" for j in E])
    box = ", ".join(
        [f"(-1 + g{j} * 0.5)::DOUBLE AS lo{j}, (-0.5 + g{j} * 0.5)::DOUBLE AS hi{j}, (-0.75 + g{j} * 0.5)::DOUBLE AS threshold{j}"
         for j in (0, 1)])
    half = f"greatest(ceil(least(greatest(x, -1.0), 1.0) * 16) + 15, 0)::INTEGER"
    return {
        "cell_assign_d3": _with(LINE_PTS) + f"SELECT l_orderkey, l_linenumber, price, {_coordinates(3)} FROM pts",
        "cell_stats_d3": _with(LINE_PTS, _level(3, "l3")) + f"SELECT {keys4}, n, {_rounded(means4)} FROM l3",
        "cell_rollup_d1_d6": _levels_union(f"SELECT depth, {keys4}, n, {_rounded(means4)} FROM l{{i}}"),
        "cell_stats_customer_bounds":
            "SELECT g0, count(*) AS n, round(avg(c_acctbal), 6) AS m0 FROM (SELECT c_acctbal, " + half + " AS g0 FROM "
            "(SELECT c_acctbal, 2.0 * (c_acctbal - (-1000.0)) / 11000.0 - 1.0 AS x FROM customer)) GROUP BY g0",
        "logistic_optimality": OPTIMALITY,
        "cell_geometry_own_box": _own_geometry(4),
        "cell_geometry_d2":
            f"SELECT g0, g1, count(*) AS n, {box} FROM (SELECT {_coordinate('x0', 2)} AS g0, {_coordinate('x1', 2)} AS g1 FROM "
            f"(SELECT {_unit('p_size', 'part')} AS x0, {_unit('p_retailprice', 'part')} AS x1 FROM part)) GROUP BY g0, g1",
        "hypercube_bits":
            _with(LINE_PTS) + f"SELECT (g0 % 2 + 2 * (g1 % 2) + 4 * (g2 % 2) + 8 * (g3 % 2))::BIGINT AS hypercube, count(*) AS n "
            f"FROM (SELECT {_coordinates(2)} FROM pts) GROUP BY 1",
        "cell_ordinals_d2": _with(LINE_PTS) + f"SELECT l_orderkey, l_linenumber, price, dense_rank() OVER (ORDER BY "
            + " + ".join(f"(g{j} // 2) * {2**j}" for j in D) + ", " + " + ".join(f"(g{j} % 2) * {2**j}" for j in D)
            + f") - 1 AS ordinal FROM (SELECT *, {_coordinates(2)} FROM pts)",
        "instance_ratio_by_depth": _levels_union(
            "SELECT {i} AS depth, count(*) AS n_cells, sum(n)::BIGINT AS n_rows, round(count(*)::DOUBLE / sum(n), 9) AS instance_ratio FROM l{i}"),
        "first_depth_ge_k": FIRST_DEPTHS,
        "seed_cells_hash": _with(LINE_PTS, _level(2, "l2"))
            + "SELECT (row_number() OVER (ORDER BY h, g0, g1, g2, g3) - 1)::INTEGER AS k, "
            + ", ".join(f"round(m{j}, 6) AS c{j}" for j in D)
            + f" FROM (SELECT *, {_hash(q.SEED, 'g0, g1, g2, g3')} AS h FROM l2) ORDER BY k LIMIT 5",
        "assign_fixed_centers": _with(LINE_PTS, _centers("c0", q.LINE_CENTERS), _assigned("near", "pts", "c0"))
            + "SELECT l_orderkey, l_linenumber, price, k::INTEGER AS prediction, round(d2, 6) AS d2 FROM pts JOIN near USING (rid)",
        "assign_embeddings_arrow": f"WITH {WIDE_CENTERS}, g AS (SELECT vec_id, k, sum((x - c) * (x - c)) AS d2 FROM flat JOIN wc USING (j) "
            "GROUP BY vec_id, k) SELECT vec_id, arg_min(k, (d2, k))::INTEGER AS prediction, round(min(d2), 6) AS d2 FROM g GROUP BY vec_id",
        "row_norms": _with(EMB_PTS) + "SELECT vec_id, round(sqrt(" + " + ".join(
            f"(x{j} - {_lit(c)}) * (x{j} - {_lit(c)})" for j, c in enumerate(q.EMBEDDING_CENTERS[0])) + "), 6) AS norm FROM pts",
        "sse_fixed_centers": _with(LINE_PTS, _centers("c0", q.LINE_CENTERS), _assigned("near", "pts", "c0"))
            + "SELECT round(sum(d2), 6) AS sse FROM near",
        "lloyd_steps_3": _with(LINE_PTS, _centers("c0", q.LINE_CENTERS), *steps3) + f"SELECT k::INTEGER AS k, {centers4} FROM {at3}",
        "weighted_lloyd_cells_2": _with(LINE_PTS, _centers("c0", q.LINE_CENTERS), _level(3, "l3"), _cell_points("l3", "p3"), *cells2)
            + f"SELECT k::INTEGER AS k, {centers4} FROM {at2}",
        "recursive_fit_2_levels": _with(*two) + history,
        "recursive_fit_own_box": _own_box_fit(3),
        "center_trajectory": _with(*two) + shift,
        "labels_by_level": _with(*two, _assigned("f1", "pts", "after1"), _assigned("f2", "pts", "after2"))
            + "SELECT f1.k::INTEGER AS level1, f2.k::INTEGER AS level2, count(*) AS n FROM f1 JOIN f2 USING (rid) GROUP BY 1, 2",
        "recursive_instance_ratio": _instance_ratios(),
        "recursive_score": _with(LINE_PTS, _centers("c0", q.LINE_CENTERS), _level(1, "l1"), _cell_points("l1", "p1"),
                                 _assigned("a0", "p1", "c0"), _moved("c1", "a0"), _assigned("near", "pts", "c1"))
            + "SELECT round(avg((k = l_linenumber)::INTEGER), 6) AS score FROM pts JOIN near USING (rid)",
        "kmeanspp_seed": _with(EMB_PTS, *seeds) + f"SELECT k::INTEGER AS k, {centers_e} FROM c0",
        "kmeanspp_two_steps": _with(EMB_PTS, *seeds, *after_seeds) + f"SELECT k::INTEGER AS k, {centers_e} FROM {at_seeds}",
        "minibatch_three_batches": _with(EMB_PTS, _centers("c0", q.EMBEDDING_CENTERS), *batches)
            + f"SELECT k::INTEGER AS k, {centers_e} FROM {at_batches}",
        "distance_cost_grid": "SELECT c_nationkey, k, b, n, (0.5 * k * (k + 1) * n + k * n * 10)::DOUBLE AS kmeans_pp, "
            "(0.5 * k * (k + 1) * n + k * b * 10)::DOUBLE AS mini_batch FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), "
            "(VALUES (3), (9)) kk(k), (VALUES (100), (500), (1000)) bb(b)",
        "minmax": _scaled("(c_acctbal - lo) / (hi - lo)"),
        "zscore_pop": _scaled("(c_acctbal - mu) / sd"),
        "zscore_mean_alias": _scaled("(c_acctbal - mu) / sd"),
        "sign_unit": _scaled("sign(c_acctbal)::DOUBLE", "1.0"),
        "maxabs": "SELECT c_custkey, round(c_acctbal / (SELECT max(abs(c_acctbal)) FROM customer), 6) AS c_acctbal FROM customer",
        "label_encode": "SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INTEGER AS o_orderpriority, "
            "(dense_rank() OVER (ORDER BY o_orderstatus) - 1)::INTEGER AS o_orderstatus FROM orders",
        "encoder_mapping": " UNION ALL ".join(
            f"SELECT '{c}' AS column, {c} AS value, (dense_rank() OVER (ORDER BY {c}) - 1)::INTEGER AS code FROM (SELECT DISTINCT {c} FROM part)"
            for c in ("p_brand", "p_type")),
        "target_encode": "SELECT p_partkey, (dense_rank() OVER (ORDER BY p_size) - 1)::INTEGER AS p_size, "
            "(SELECT count(DISTINCT p_size) FROM part) AS n_targets FROM part",
        "one_hot": "SELECT c_custkey, " + ", ".join(
            f"(c_mktsegment = '{s}')::INTEGER AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + ", c_acctbal FROM customer",
        "impute_mode": _imputed(MODE),
        "impute_median": _imputed("(SELECT median(code) FROM coded WHERE value <> '?')"),
        "impute_mean": _imputed("(SELECT avg(code) FROM coded WHERE value <> '?')"),
        "impute_constant": _imputed("-1.0"),
        "impute_random": f"WITH {CODES}, seen AS (SELECT code, n, sum(n) OVER (ORDER BY code) - n AS lo FROM (SELECT code, count(*) AS n "
            "FROM coded WHERE value <> '?' GROUP BY code)), m AS (SELECT sum(n)::BIGINT AS m FROM seen), "
            f"drawn AS (SELECT o_orderkey, {_hash(f'{q.SEED}|priority', 'o_orderkey')} % m AS rank FROM coded, m WHERE value = '?') "
            "SELECT o_orderkey, seen.code::DOUBLE AS priority FROM drawn JOIN seen ON rank >= lo AND rank < lo + n "
            "UNION ALL SELECT o_orderkey, code::DOUBLE FROM coded WHERE value <> '?'",
        "impute_linear": f"WITH {CODES}, fit AS (SELECT regr_slope(code, o_totalprice) AS s, regr_intercept(code, o_totalprice) AS i "
            "FROM coded WHERE value <> '?') SELECT o_orderkey, round((CASE WHEN value = '?' THEN i + s * o_totalprice ELSE code END)::DOUBLE, 4) "
            "AS priority FROM coded, fit",
        "prepare_pipeline": f"WITH {CODES}, full_ AS (SELECT *, CASE WHEN value = '?' THEN {MODE} ELSE code END AS c FROM coded) "
            "SELECT o_orderkey, round((c - min(c) OVER ())::DOUBLE / (max(c) OVER () - min(c) OVER ()), 6) AS priority, "
            "round((o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()), 6) AS o_totalprice, "
            "(dense_rank() OVER (ORDER BY o_orderstatus) - 1)::INTEGER AS o_orderstatus FROM full_",
        "scale_mixed_columns": "SELECT p_partkey, " + ", ".join(
            f"round(({c} - min({c}) OVER ())::DOUBLE / (max({c}) OVER () - min({c}) OVER ()), 6) AS {n}" for c, n in
            (("b", "p_brand"), ("t", "p_type"), ("p_size", "p_size"))) +
            " FROM (SELECT p_partkey, p_size, dense_rank() OVER (ORDER BY p_brand) AS b, dense_rank() OVER (ORDER BY p_type) AS t FROM part)",
        "sample_rows_exact": f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_hash(q.SEED, 'o_orderkey')}, o_orderkey LIMIT {q.LARGE_SAMPLE}",
        "sample_rows_small": f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_hash(q.SEED, 'o_orderkey')}, o_orderkey LIMIT {q.SMALL_SAMPLE}",
        "sample_columns": f"SELECT c_custkey, {', '.join(_chosen_columns())} FROM customer",
        "drop_columns": "SELECT s_suppkey, s_acctbal FROM supplier",
        "summary_stats": " UNION ALL ".join(
            f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"min({c}) AS min, " + ", ".join(f"round(quantile_cont({c}, {p}), 6) AS q{int(100 * p)}" for p in (0.25, 0.5, 0.75))
            + f", max({c}) AS max FROM lineitem" for c in q.LINE),
        "calinski_harabasz": f"WITH {WIDE}, tot AS (SELECT j, avg(x) AS m FROM flat GROUP BY j) "
            "SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz FROM "
            "(SELECT sum(n * (c - m) * (c - m)) AS b FROM cent JOIN tot USING (j)), "
            "(SELECT sum((x - c) * (x - c)) AS w FROM flat JOIN cent USING (label, j)), "
            "(SELECT count(DISTINCT label) AS k, count(*) AS n FROM embeddings)",
        "davies_bouldin": f"WITH {WIDE}, spread AS (SELECT label, avg(g) AS s FROM (SELECT vec_id, label, sqrt(sum((x - c) * (x - c))) AS g "
            "FROM flat JOIN cent USING (label, j) GROUP BY vec_id, label) GROUP BY label), "
            "gap AS (SELECT a.label AS p, b.label AS q, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS g FROM cent a JOIN cent b USING (j) "
            "WHERE a.label <> b.label GROUP BY 1, 2) SELECT round(avg(r), 6) AS davies_bouldin FROM "
            "(SELECT p, max((x.s + y.s) / g) AS r FROM gap JOIN spread x ON x.label = p JOIN spread y ON y.label = q GROUP BY p)",
        "silhouette_exact": f"WITH {SILHOUETTE} SELECT round(avg(s), 6) AS silhouette FROM sil",
        "silhouette_rows": f"WITH {SILHOUETTE} SELECT vec_id, label, round(s, 6) AS silhouette FROM sil",
        "silhouette_squared": _with(*LABELLED, "v AS (SELECT l.vec_id, l.b AS own, " + ", ".join(f"x{j}" for j in E)
            + " FROM lab l JOIN pts USING (vec_id))", "per AS (SELECT p.vec_id, p.own, o.own AS other, sum("
            + _gap(E, "p.x", "o.x") + ") AS s, count(*) AS n FROM v p, v o GROUP BY 1, 2, 3)",
            "ab AS (SELECT vec_id, own, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, "
            "min(CASE WHEN own <> other THEN s / n END) AS b FROM per GROUP BY vec_id, own)")
            + "SELECT round(avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_sq FROM ab",
        "contingency": _with(*LABELLED) + "SELECT a AS reference, b::INTEGER AS predicted, count(*) AS n FROM lab GROUP BY a, b",
        "contingency_labels": "SELECT quality AS reference, toxic AS predicted, count(*) AS n FROM labels GROUP BY 1, 2",
        "ari": _with(*LABELLED, *AGREEMENT) + f"SELECT round({ARI}, 6) AS ari",
        "nmi": _with(*LABELLED, *AGREEMENT) + f"SELECT round({NMI}, 6) AS nmi",
        "ami": _with(*LABELLED, *AGREEMENT) + f"SELECT round({AMI}, 6) AS ami",
        "ami_lineitem": _with(*LINE_BOTH, *AGREEMENT) + f"SELECT round({AMI}, 6) AS ami, round({ARI}, 6) AS ari, round({NMI}, 6) AS nmi",
        "accuracy": _with(*LABELLED) + "SELECT round(avg((a = b)::INTEGER), 6) AS accuracy FROM lab",
        "std_error": _with(LINE_PTS, _centers("c0", q.LINE_CENTERS), _centers("c1", q.LINE_OTHER), _assigned("n0", "pts", "c0"),
                           _assigned("n1", "pts", "c1"))
            + "SELECT round((e - a) / e, 6) AS std_error FROM (SELECT sum(d2) AS e FROM n0), (SELECT sum(d2) AS a FROM n1)",
        "ideal_centers": _with(EMB_PTS) + "SELECT label, count(*) AS n, " + ", ".join(
            f"round(avg(x{j}), 6) AS m{j}" for j in E) + " FROM pts GROUP BY label",
        "average_replicas": f"WITH {RESULTS} SELECT n_clusters, n_dims, n_samples, algorithm, param, {_rounded(QUALITY_COLUMNS)} FROM means",
        "relative_error_table": _relative_table(),
        "plot_series": f"WITH {RESULTS} SELECT algorithm, param, n_samples AS x, round(calinski_harabasz, 6) AS y FROM means "
            "WHERE n_clusters = 3 AND n_dims = 1",
        "result_panels": f"WITH {RESULTS} SELECT DISTINCT n_clusters, n_dims FROM results",
        "gaussian_mixture_rows": "SELECT id, round(x0 / max(abs(x0)) OVER (), 6) AS x0, round(x1 / max(abs(x1)) OVER (), 6) AS x1, y FROM (SELECT "
            "o_orderkey AS id, (o_orderkey % 3)::INTEGER AS y, " + ", ".join(
                f"(CASE o_orderkey % 3 WHEN 0 THEN {_lit(q.MIXTURE_CENTERS[0][j])} WHEN 1 THEN {_lit(q.MIXTURE_CENTERS[1][j])} "
                f"ELSE {_lit(q.MIXTURE_CENTERS[2][j])} END) + {_lit(q.MIXTURE_SIGMA)} * {_normal(f'{q.SEED}|0|{j}', 'o_orderkey')} AS x{j}"
                for j in (0, 1)) + " FROM orders)",
        "gaussian_mixture_counts": "SELECT (o_orderkey % 4)::INTEGER AS y, count(*) AS n FROM orders GROUP BY 1",
        "csv_round_trip": "SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer",
        "supervised_view": "SELECT count(*) AS rows, round(sum(p_retailprice), 6) AS total, 5::BIGINT AS features, 'p_retailprice' AS target FROM part",
        "arff_round_trip": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
        "sensor_text_round_trip": "SELECT vec_id::DOUBLE AS time, label::DOUBLE AS methane, part::DOUBLE AS ethylene, " + ", ".join(
            f"round(embedding[16 * part + {j + 1}]::DOUBLE, 6) AS attr{j}" for j in range(16))
            + " FROM embeddings, (SELECT unnest(range(4)) AS part)",
        "sensor_own_headers": "SELECT CASE vec_id % 2 WHEN 0 THEN 'Methane_conc_(ppm)' ELSE 'CO_conc_(ppm)' END AS second, "
            "vec_id::DOUBLE AS time, label::DOUBLE AS gas, part::DOUBLE AS ethylene, " + ", ".join(
            f"round(embedding[16 * part + {j + 1}]::DOUBLE, 6) AS attr{j}" for j in range(16))
            + " FROM embeddings, (SELECT unnest(range(4)) AS part)",
        "result_sink": f"WITH {RESULTS} SELECT n_clusters, algorithm, param, round(avg(silhouette), 6) AS silhouette FROM results GROUP BY ALL",
        "stream_scores": f"SELECT event_id, list_min([{EVENT_GAP}])[2]::INTEGER AS prediction FROM events",
        "stream_cells": "SELECT g0, count(*) AS n, round(avg(value), 6) AS m0 FROM (SELECT value, greatest(ceil(least(greatest("
            "2.0 * value / 100.0 - 1.0, -1.0), 1.0) * 8) + 7, 0)::INTEGER AS g0 FROM events) GROUP BY g0",
    }
