"""SQL oracles (DuckDB dialect) for the registered queries.

Each string computes the same result as ``statforge.plans.queries`` straight
from the typed tables. The k-means oracles are generated: one block of CTEs
per iteration (assign, average, test), unrolled to the iteration cap, with the
same convergence test as the Spark fit so both stop at the same iteration.
"""

from __future__ import annotations

from statforge.operators.kmeans import RAW_MAX_ITER, TOLERANCE
from statforge.plans import queries as q

TAB = "chr(9)"

LINEITEM_LINE = (
    "concat_ws(chr(9), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
    "CAST(l_linenumber AS VARCHAR), CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), "
    "CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR))"
)

LINEITEM_ORDER_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _xs(d: int, prefix: str = "", fmt: str = "x{j}") -> str:
    return ", ".join(f"{prefix}{fmt.format(j=j)}" for j in range(d))


def _nearest_cte(points: str, centers: str, d: int) -> str:
    """``SELECT id, cid`` of the nearest centroid for every point.

    The k centroids of ``centers`` come as one list from an uncorrelated scalar
    subquery; distances are summed left to right like the Spark expression,
    and the first minimum wins (ties to the lowest index).
    """
    coords = ", ".join(f"x{j}" for j in range(d))
    sq = " + ".join(f"(p.x{j} - c[{j + 1}]) * (p.x{j} - c[{j + 1}])" for j in range(d))
    dists = f"list_transform((SELECT list([{coords}] ORDER BY cid) FROM {centers}), lambda c: sqrt({sq}))"
    return f"SELECT id, CAST(list_position(dl, list_min(dl)) - 1 AS INTEGER) AS cid FROM (SELECT p.id, {dists} AS dl FROM {points} p) n"


def kmeans_ctes(points_sql: str, init_sql: str, d: int, max_iter: int, tol: float, rule: str) -> list[str]:
    """CTEs ``p`` (id, x0..), ``c0`` .. ``c{max_iter}`` (cid, x0.., n, done, it)
    and ``t{i}`` (one trace row per performed iteration)."""
    ctes = [f"p AS ({points_sql})"]
    ctes.append(
        f"c0 AS (SELECT CAST(cid AS INTEGER) AS cid, {_xs(d)}, CAST(0 AS BIGINT) AS n, FALSE AS done, 0 AS it FROM ({init_sql}) i0)"
    )
    for i in range(max_iter):
        ctes.append(f"a{i} AS ({_nearest_cte('p', f'c{i}', d)})")
        avgs = ", ".join(f"avg(p.x{j}) AS x{j}" for j in range(d))
        ctes.append(f"u{i} AS (SELECT a.cid, count(*) AS n, {avgs} FROM a{i} a JOIN p ON a.id = p.id GROUP BY a.cid)")
        news = ", ".join(f"coalesce(u.x{j}, c.x{j}) AS nx{j}" for j in range(d))
        olds = ", ".join(f"c.x{j} AS ox{j}" for j in range(d))
        mv_sq = " + ".join(f"(nx{j} - ox{j}) * (nx{j} - ox{j})" for j in range(d))
        mv_abs = ", ".join(f"abs(nx{j} - ox{j})" for j in range(d))
        mv_abs = f"greatest({mv_abs})" if d > 1 else mv_abs
        ctes.append(
            f"m{i} AS (SELECT c.cid, c.done, c.it, c.n AS on_, coalesce(u.n, 0) AS nn, {news}, {olds} "
            f"FROM c{i} c LEFT JOIN u{i} u ON c.cid = u.cid)"
        )
        ctes.append(f"s{i} AS (SELECT max({mv_abs}) AS max_abs, max({mv_sq}) AS max_sq FROM m{i})")
        measure = f"(SELECT max_abs FROM s{i})" if rule == "max_abs" else f"(SELECT max_sq FROM s{i})"
        conv = f"{measure} <= {tol!r}"
        keep = ", ".join(f"CASE WHEN m.done THEN m.ox{j} ELSE m.nx{j} END AS x{j}" for j in range(d))
        ctes.append(
            f"c{i + 1} AS (SELECT m.cid, {keep}, CASE WHEN m.done THEN m.on_ ELSE m.nn END AS n, "
            f"(m.done OR ({conv})) AS done, CASE WHEN m.done THEN m.it ELSE {i + 1} END AS it FROM m{i} m)"
        )
        ctes.append(
            f"t{i} AS (SELECT {i + 1} AS iteration, s.max_abs AS max_abs_shift, s.max_sq AS max_squared_shift, "
            f"({conv}) AS converged FROM s{i} s WHERE NOT (SELECT bool_or(done) FROM c{i}))"
        )
    return ctes


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _centers_select(last: int, d: int) -> str:
    cols = ", ".join(f"round(x{j}, 6) AS x{j}" for j in range(d))
    return f"SELECT cid AS cluster, {cols}, n FROM c{last}"


def _nearest_select(last: int, d: int, points: str = "p") -> str:
    return _nearest_cte(points, f"c{last}", d).replace("AS cid FROM", "AS cluster FROM", 1)


# --------------------------------------------------------------------------- point / start definitions
_MOMENTS_CTE = (
    "mom AS (SELECT avg(l_quantity) AS m0, stddev_pop(l_quantity) AS s0, avg(l_extendedprice) AS m1, "
    "stddev_pop(l_extendedprice) AS s1, avg(l_discount) AS m2, stddev_pop(l_discount) AS s2 FROM lineitem)"
)

_ROW_ID = "row_number() OVER (ORDER BY " + LINEITEM_ORDER_SQL + ") AS id"

def _mom(name: str) -> str:
    return f"(SELECT {name} FROM mom)"


# standardised features, moments from the one-row ``mom`` CTE
_Z = (
    f"(l_quantity - {_mom('m0')}) / {_mom('s0')} AS x0, (l_extendedprice - {_mom('m1')}) / {_mom('s1')} AS x1, "
    f"(l_discount - {_mom('m2')}) / {_mom('s2')} AS x2"
)

_STD_POINTS = "SELECT " + _ROW_ID + ", l_orderkey, l_linenumber, " + _Z + " FROM lineitem"

_STD_INIT_FIRST = (
    "SELECT row_number() OVER (ORDER BY " + LINEITEM_ORDER_SQL + ") - 1 AS cid, " + _Z.replace("{", "{{").replace("}", "}}")
    + " FROM (SELECT * FROM lineitem ORDER BY " + LINEITEM_ORDER_SQL + " LIMIT {k}) f"
)

_RAW_POINTS = "SELECT " + _ROW_ID + ", l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem"

_RAW_INIT_FIRST = (
    "SELECT row_number() OVER (ORDER BY " + LINEITEM_ORDER_SQL + ") - 1 AS cid, l_quantity AS x0, l_discount AS x1, "
    "l_tax AS x2 FROM (SELECT * FROM lineitem ORDER BY " + LINEITEM_ORDER_SQL + " LIMIT {k}) f"
)


def _std_fit_ctes(k: int) -> list[str]:
    return [_MOMENTS_CTE] + kmeans_ctes(_STD_POINTS, _STD_INIT_FIRST.format(k=k), 3, q.STD_MAX_ITER, TOLERANCE, "squared_shift")


def _raw_fit_ctes(k: int) -> list[str]:
    return kmeans_ctes(_RAW_POINTS, _RAW_INIT_FIRST.format(k=k), 3, RAW_MAX_ITER, TOLERANCE, "max_abs")


# A row's number in its file; the file's path below the tables' folder is its name.
_ROW_NUMBER = "row_number() OVER () - 1 AS line_no"


def _position_rank(table: str) -> str:
    return f"md5('0:{table}.parquet:' || line_no)"


def _subset_where() -> str:
    return "l_quantity <= 25 AND l_extendedprice <= 50000 AND l_linestatus = 'O' AND l_returnflag IN ('A', 'R')"


def _clustering_sql(k: int, subset: bool) -> str:
    where = f"WHERE {_subset_where()}" if subset else ""
    points = "SELECT " + _ROW_ID + ", " + _Z + f" FROM lineitem {where}"
    init = (
        "SELECT row_number() OVER (ORDER BY rank) - 1 AS cid, " + _Z + " FROM (SELECT *, "
        + _position_rank("lineitem")
        + f" AS rank FROM (SELECT *, {_ROW_NUMBER} FROM lineitem) n {where} ORDER BY rank LIMIT {k}) f"
    )
    ctes = [_MOMENTS_CTE] + kmeans_ctes(points, init, 3, q.STD_MAX_ITER, TOLERANCE, "squared_shift")
    last = q.STD_MAX_ITER
    return _with(ctes, f"SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n FROM ({_nearest_select(last, 3)}) z GROUP BY cluster")


def _embeddings_sql(k: int) -> str:
    # Array form, unrolled like the column form; distances summed left to right.
    max_iter, tol = RAW_MAX_ITER, TOLERANCE
    ctes = [
        "p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cid, CAST(embedding AS DOUBLE[]) AS v, "
        f"CAST(0 AS BIGINT) AS n, FALSE AS done FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT {k}) f)",
    ]
    dist = "sqrt(list_reduce(list_transform(p.v, lambda x, j: (x - c[j]) * (x - c[j])), lambda a, b: a + b))"
    for i in range(max_iter):
        dl = f"list_transform((SELECT list(v ORDER BY cid) FROM c{i}), lambda c: {dist})"
        ctes.append(
            f"a{i} AS (SELECT id, CAST(list_position(dl, list_min(dl)) - 1 AS INTEGER) AS cid "
            f"FROM (SELECT p.id, {dl} AS dl FROM p) n)"
        )
        ctes.append(
            f"e{i} AS (SELECT a.cid, unnest(generate_series(1, len(p.v))) AS j, unnest(p.v) AS x FROM a{i} a JOIN p ON a.id = p.id)"
        )
        ctes.append(f"g{i} AS (SELECT cid, j, avg(x) AS x FROM e{i} GROUP BY cid, j)")
        ctes.append(f"h{i} AS (SELECT cid, list(x ORDER BY j) AS v FROM g{i} GROUP BY cid)")
        ctes.append(f"n{i} AS (SELECT cid, count(*) AS n FROM a{i} GROUP BY cid)")
        ctes.append(
            f"m{i} AS (SELECT c.cid, c.done, c.n AS on_, coalesce(n.n, 0) AS nn, coalesce(h.v, c.v) AS nv, c.v AS ov "
            f"FROM c{i} c LEFT JOIN h{i} h ON c.cid = h.cid LEFT JOIN n{i} n ON c.cid = n.cid)"
        )
        ctes.append(
            f"s{i} AS (SELECT max(list_max(list_transform(nv, lambda x, j: abs(x - ov[j])))) AS max_abs FROM m{i})"
        )
        ctes.append(
            f"c{i + 1} AS (SELECT m.cid, CASE WHEN m.done THEN m.ov ELSE m.nv END AS v, CASE WHEN m.done THEN m.on_ ELSE m.nn END AS n, "
            f"(m.done OR (SELECT max_abs FROM s{i}) <= {tol!r}) AS done FROM m{i} m)"
        )
    return _with(
        ctes,
        f"SELECT cid AS cluster, n, round(list_reduce(v, lambda a, b: a + b), 6) AS center_sum, "
        f"round(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b), 6) AS center_sq FROM c{max_iter}",
    )


def _standardised_sql() -> str:
    return (
        f"WITH {_MOMENTS_CTE} SELECT l_orderkey, l_linenumber, round((l_quantity - {_mom('m0')}) / {_mom('s0')}, 6) AS z0, "
        f"round((l_extendedprice - {_mom('m1')}) / {_mom('s1')}, 6) AS z1, "
        f"round((l_discount - {_mom('m2')}) / {_mom('s2')}, 6) AS z2 FROM lineitem"
    )


def _profile_sql() -> str:
    numeric = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    parts = [
        f"SELECT {i} AS col_idx, round(avg(CAST({c} AS DOUBLE)), 8) AS mean, round(stddev_pop(CAST({c} AS DOUBLE)), 6) AS std FROM lineitem"
        for i, c in enumerate(numeric)
    ]
    parts += [f"SELECT {i} AS col_idx, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std" for i in (8, 9, 10)]
    return "\nUNION ALL\n".join(parts)


def _trace_sql() -> str:
    ctes = _std_fit_ctes(q.K)
    n = q.STD_MAX_ITER
    union = " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(n))
    return _with(
        ctes,
        f"SELECT CAST(iteration AS INTEGER) AS iteration, round(max_abs_shift, 6) AS max_abs_shift, "
        f"round(max_squared_shift, 6) AS max_squared_shift, converged FROM ({union}) tr",
    )


def _drop_counts_sql() -> str:
    first, last = q.SONG_YEARS
    year = f"year(o_orderdate) BETWEEN {first} AND {last}"
    counted = {
        ("year_range_projection", "records", "orders"): {
            "read": "count(*)",
            "kept": f"count(*) FILTER (o_orderstatus <> 'P' AND {year})",
            "year is not an integer": "count(*) FILTER (o_orderstatus = 'P')",
            "year out of range": f"count(*) FILTER (o_orderstatus <> 'P' AND NOT {year})",
        },
        ("ngram_volume_stddev", "unigrams", "customer"): {"read": "count(*)", "kept": "count(*)", "volumes are not an integer": "count(*) FILTER (false)"},
        ("ngram_volume_stddev", "bigrams", "part"): {
            "read": "count(*)",
            "kept": "count(*) FILTER (p_type <> 'PROMO')",
            "volumes are not an integer": "count(*) FILTER (p_type = 'PROMO')",
        },
        ("column_moments", "records", "lineitem"): {"read": "count(*)", "fields that are not numbers": "3 * count(*)"},
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{job}' AS job, '{source}' AS source, '{what}' AS what, CAST({n} AS BIGINT) AS n FROM {table}"
        for (job, source, table), by in counted.items()
        for what, n in by.items()
    )


def oracle_sql() -> dict[str, str]:
    std_last = q.STD_MAX_ITER
    return {
        "csv_flag_mean": (
            "SELECT concat_ws(', ', l_returnflag, l_linestatus, CAST(year(l_shipdate) AS VARCHAR), CAST(l_linenumber AS VARCHAR)) "
            "AS group_key, avg(l_quantity) AS mean_value FROM lineitem WHERE l_discount < 0.05 GROUP BY 1"
        ),
        "fixed_width_max": (
            "SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, greatest(max(t), -9999) AS max_value FROM ("
            "SELECT l_shipdate, l_linenumber, CASE WHEN l_returnflag = 'R' THEN -m ELSE m END AS t FROM ("
            "SELECT *, CASE WHEN l_quantity = 50 THEN 9999 ELSE CAST(floor(l_extendedprice / 100) AS INTEGER) END AS m "
            "FROM lineitem) a) b WHERE l_linenumber IN (0, 1, 4, 5, 9) AND t <> 9999 GROUP BY 1"
        ),
        "year_range_project": (
            "SELECT CAST(o_custkey AS VARCHAR) AS artist, CAST(o_totalprice AS VARCHAR) AS duration, o_orderpriority AS title, "
            "CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders WHERE o_orderstatus <> 'P' "
            f"AND year(o_orderdate) BETWEEN {q.SONG_YEARS[0]} AND {q.SONG_YEARS[1]}"
        ),
        "group_max_floor": (
            "SELECT c_mktsegment || '#' || CAST(c_nationkey AS VARCHAR) AS key, "
            "greatest(max(c_acctbal - 9500.0), 0.0) AS max_value FROM customer GROUP BY 1"
        ),
        "range_bucket_max": (
            "SELECT p_name AS key, greatest(max(p_retailprice - 975.0), 0.0) AS max_value, "
            "CASE WHEN substr(p_name, 1, 1) < 'f' THEN 0 WHEN substr(p_name, 1, 1) < 'k' THEN 1 "
            "WHEN substr(p_name, 1, 1) < 'p' THEN 2 WHEN substr(p_name, 1, 1) < 'u' THEN 3 ELSE 4 END AS bucket "
            "FROM part GROUP BY p_name"
        ),
        "substring_mean": (
            "WITH subs(s) AS (VALUES ('ol'), ('ar'), ('in')), "
            "uni AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN lpad(CAST(1990 + c_nationkey AS VARCHAR), 5, '0') "
            "ELSE CAST(1990 + c_nationkey AS VARCHAR) END AS y, lower(c_mktsegment) AS w0, CAST(floor(c_acctbal) AS BIGINT) AS v FROM customer), "
            "bi AS (SELECT CAST(1950 + p_size AS VARCHAR) AS y, lower(split_part(p_name, ' ', 1)) AS w0, "
            "lower(split_part(p_name, ' ', 2)) AS w1, CAST(floor(p_retailprice) AS BIGINT) AS v FROM part WHERE p_type <> 'PROMO'), "
            "m AS (SELECT y, s, v FROM uni JOIN subs ON contains(w0, s) "
            "UNION ALL SELECT y, s, v FROM bi JOIN subs ON contains(w0, s) OR contains(w1, s)) "
            "SELECT y || ' | ' || s AS tag_key, avg(v) AS mean_volumes FROM m GROUP BY 1"
        ),
        "union_stddev": (
            "SELECT round(stddev_pop(v), 6) AS stddev FROM (SELECT CAST(floor(c_acctbal) AS BIGINT) AS v FROM customer "
            "UNION ALL SELECT CAST(floor(p_retailprice) AS BIGINT) AS v FROM part WHERE p_type <> 'PROMO') u"
        ),
        "column_profile": _profile_sql(),
        "row_subset": f"SELECT {LINEITEM_LINE} AS value FROM lineitem WHERE {_subset_where()}",
        "standardise": _standardised_sql(),
        "kmeans_raw": _with(_raw_fit_ctes(q.K), _centers_select(RAW_MAX_ITER, 3)),
        "kmeans_standardised": _with(_std_fit_ctes(q.K), _centers_select(std_last, 3)),
        "kmeans_trace": _trace_sql(),
        "kmeans_resumed": _trace_sql(),
        "cluster_assign": _with(
            _std_fit_ctes(q.K),
            f"SELECT p.l_orderkey, p.l_linenumber, CAST(z.cluster AS INTEGER) AS cluster "
            f"FROM ({_nearest_select(std_last, 3)}) z JOIN p ON z.id = p.id",
        ),
        "clustering_end_to_end": _clustering_sql(q.CLUSTER_K, subset=False),
        "clustering_given_moments": _clustering_sql(q.SUBSET_CLUSTER_K, subset=True),
        "kmeans_embeddings": _embeddings_sql(q.EMBED_K),
        "sample_k": (
            f"SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, {_ROW_NUMBER} FROM orders) n "
            f"ORDER BY {_position_rank('orders')} LIMIT {q.SAMPLE_K}"
        ),
        "redelimit": (
            "SELECT concat_ws(chr(9), CAST(p_partkey AS VARCHAR), split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), "
            "p_brand, p_type, CAST(p_size AS VARCHAR)) AS value, "
            "concat_ws(chr(9), CAST(p_partkey AS VARCHAR), split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), "
            "p_brand, p_type) AS cut FROM part"
        ),
        "header_skip": (
            "SELECT p_partkey AS partkey, p_name AS name, p_retailprice AS price FROM part "
            "UNION ALL SELECT NULL, 'p_name', NULL"  # the data row that equals the header
        ),
        "value_lines": "SELECT concat_ws('/', o_orderkey, o_orderpriority, o_orderstatus) AS order_value FROM orders",
        "merged_lines": (
            "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS line_no, "
            "concat_ws(chr(9), o_orderkey, o_orderstatus, o_orderpriority) AS value FROM orders"
        ),
        "drop_counts": _drop_counts_sql(),
        "wide_profile": (
            "SELECT CAST(j AS INTEGER) AS col_idx, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM ("
            "SELECT unnest(range(128)) AS j, unnest(list_concat(e, list_transform(e, lambda v: CAST(CAST(v AS FLOAT) * CAST(v AS FLOAT) AS DOUBLE)))) AS x "
            "FROM (SELECT CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a) b GROUP BY j"
        ),
        "range_parts": (
            "SELECT p_name AS key, greatest(max(p_retailprice - 975.0), 0.0) AS max_value, "
            "CASE WHEN substr(p_name, 1, 1) < 'f' THEN 0 WHEN substr(p_name, 1, 1) < 'k' THEN 1 "
            "WHEN substr(p_name, 1, 1) < 'p' THEN 2 WHEN substr(p_name, 1, 1) < 'u' THEN 3 ELSE 4 END AS bucket, "
            "TRUE AS in_order FROM part GROUP BY p_name"
        ),
        "moments_positions": _standardised_sql(),
        "kmeans_wide_text": _embeddings_sql(q.EMBED_K),
        "text_roundtrip": "SELECT s_name, s_acctbal FROM supplier",
        "moments_file": _profile_sql(),
        "centroid_file": _with(
            _std_fit_ctes(q.K), "SELECT cid AS cluster, " + ", ".join(f"round(x{j}, 6) AS x{j}" for j in range(3)) + f" FROM c{std_last}"
        ),
    }
