"""The registered queries as SQL for an independent engine.

Sums are exact decimals and expressions keep the order of the operators, so results
agree to the last bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from trendspark.settings import (
    CENSUS_VARIABLES,
    CENSUS_YEARS,
    COUNT_COLUMNS,
    COUNT_TREND_WEIGHTS,
    IMPORTANCE_TARGET,
    REPORT_COLUMNS,
    SALES_COLUMNS,
    SALES_TREND_WEIGHTS,
    SCORING_COLUMNS,
    SUM_WEIGHTS,
    YEARS,
)

_LATEST_FIRST = sorted(YEARS, reverse=True)
_CENSUS_COLUMNS = [(y, code, f"{name}_{y}") for y in CENSUS_YEARS for code, name in CENSUS_VARIABLES.items()]

# --- input tables -------------------------------------------------------------

_MERCHANTS = f"""
merchants AS (
  SELECT s_suppkey AS MERCHANT_ID, s_name AS MERCHANT_NAME, CAST(5811 + s_suppkey % 3 AS VARCHAR) AS MCC,
         r_name AS BILLING_STATE, CASE WHEN s_suppkey % 5 = 0 THEN concat(n_name, ' ') ELSE n_name END AS CITY,
         lpad(CAST(1000 + (s_suppkey % 37) * 101 AS VARCHAR), 5, '0') AS ZIPCODE,
         CAST(1000 * (s_nationkey + 1) AS BIGINT) AS POPULATION,
         {", ".join(
             f"CAST(sum(CASE WHEN (year(l_shipdate) - 1990) % 4 = {y - 2018} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) "
             f"AS DOUBLE) AS {c}" for y, c in zip(YEARS, SALES_COLUMNS))},
         {", ".join(f"count(CASE WHEN (year(l_shipdate) - 1990) % 4 = {y - 2018} THEN 1 END) AS {c}"
                    for y, c in zip(YEARS, COUNT_COLUMNS))}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY s_suppkey, s_name, s_nationkey, r_name, n_name)"""

_BANK = """
bank AS (
  SELECT concat(CASE WHEN n_nationkey % 7 = 0 THEN 'Old ' ELSE '' END, n_name, CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE '' END)
           AS MERCHANT_CITY_NAME, r_name AS MERCHANT_STATE_XCD,
         concat(' ', CAST(5811 + c_custkey % 3 AS VARCHAR), ' ') AS MERCHANT_CATEGORY_XCD,
         CAST(year(o_orderdate) + 20 AS INTEGER) AS YEAR_run,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS TOT_SUM, count(*) AS TOT_CNT
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)"""

_CENSUS = f"""
by_zip AS (
  SELECT CASE WHEN c_custkey % 37 % 11 = 0 THEN '9' ELSE '0' END
           || right(lpad(CAST(1000 + (c_custkey % 37) * 101 AS VARCHAR), 5, '0'), 4) AS zipcode,
         count(CASE WHEN c_custkey % 2 = 0 THEN 1 END) AS even, count(CASE WHEN c_custkey % 2 = 1 THEN 1 END) AS odd
  FROM customer GROUP BY 1),
census AS (
  SELECT zipcode, {", ".join(
      f"{'even' if c.startswith('population_male') else 'odd'} + {y - 2018} AS {c}" for y, _, c in _CENSUS_COLUMNS)}
  FROM by_zip)"""

# --- operators ----------------------------------------------------------------


def _change(current: str, previous: str, base: str) -> str:
    return f"(CAST({current} AS DOUBLE) - CAST({previous} AS DOUBLE)) / nullif(CAST({base} AS DOUBLE), 0)"


def _mean(columns: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"CAST({c} AS DOUBLE)" for c in columns) + f") / {len(columns)}"


def _weighted(columns: tuple[str, ...], weights: tuple[float, ...]) -> str:
    # e-notation keeps the literal a double
    return " + ".join(f"{c} * {w}e0" for c, w in zip(columns, weights))


_S, _C = SALES_COLUMNS, COUNT_COLUMNS
_TRENDS = {
    "SALES_TREND_1": _change(_S[1], _S[0], _S[1]),
    "SALES_TREND_2": _change(_S[2], _S[1], _S[1]),
    "SALES_TREND_3": _change(_S[3], _S[2], _S[2]),
    "SALES_CNT_TREND_1": _change(_C[1], _C[0], _C[0]),
    "SALES_CNT_TREND_2": _change(_C[2], _C[1], _C[1]),
    "SALES_CNT_TREND_3": _change(_C[3], _C[2], _C[2]),
}
_AVERAGES = {"AVG_SALES": _mean(_S), "AVG_SALES_CNT": f"round({_mean(_C)}, 0)"}


def _named(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in expressions.items())


_FEATURES = f"""
features AS (
  SELECT * FROM (SELECT *, {_named(_AVERAGES)}, {_named(_TRENDS)} FROM merchants)
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*_AVERAGES, *_TRENDS, *_S, *_C])})"""

_SALES_WEIGHTED = _weighted(("SALES_TREND_1", "SALES_TREND_2"), SALES_TREND_WEIGHTS)
_COUNT_WEIGHTED = _weighted(("SALES_CNT_TREND_1", "SALES_CNT_TREND_2"), COUNT_TREND_WEIGHTS)
_RANKED = f"""
weighted AS (
  SELECT *, (SALES_TREND_WEIGHTED + SALE_CNT_TREND_WEIGHTED) / 2 AS TREND_WEIGHTED
  FROM (SELECT *, {_SALES_WEIGHTED} AS SALES_TREND_WEIGHTED, {_COUNT_WEIGHTED} AS SALE_CNT_TREND_WEIGHTED
        FROM features)),
ranked AS (SELECT *, rank() OVER (ORDER BY TREND_WEIGHTED) AS TREND_RANKING FROM weighted)"""


def _limits(source: str, columns) -> str:
    cells = ", ".join(f"min({c}) AS low_{c}, max({c}) AS high_{c}" for c in columns)
    return f"limits AS (SELECT {cells} FROM {source})"


def _scaled(column: str, direction: int) -> str:
    part = f"({column} - low_{column}) / (high_{column} - low_{column})"
    constant, value = ("0e0", part) if direction else ("1e0", f"1 - {part}")
    return f"CASE WHEN high_{column} = low_{column} THEN {constant} ELSE {value} END"


_SCORE = " + ".join(_scaled(c, 1) for c in SCORING_COLUMNS)
_ROUNDED = f"round_even(({_weighted(SCORING_COLUMNS, SUM_WEIGHTS)}) * 100, 0) / 100"
_WEIGHTED_SUM = f"CASE WHEN {_ROUNDED} = 0 THEN 0e0 ELSE {_ROUNDED} END"
_LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _report(source: str) -> str:
    names = ", ".join(c for c in REPORT_COLUMNS if c != "WEIGHTED_SUM")
    return f"""SELECT DISTINCT {", ".join(SCORING_COLUMNS)}, {_SCORE} AS SCORE, {names},
        {_WEIGHTED_SUM} AS WEIGHTED_SUM FROM {source}, limits"""


def _pivot(legacy: bool) -> str:
    amounts = ", ".join(
        f"sum(CASE WHEN YEAR_run = {2019 if legacy and y == 2018 else y} THEN TOT_SUM END) AS \"{y}Tot\""
        for y in _LATEST_FIRST
    )
    counts = ", ".join(f"sum(CASE WHEN YEAR_run = {y} THEN TOT_CNT END) AS \"{y}CNT\"" for y in _LATEST_FIRST)
    return f"""SELECT trim(MERCHANT_CITY_NAME) AS MERCHANT_CITY_NAME, trim(MERCHANT_STATE_XCD) AS MERCHANT_STATE_XCD,
        trim(MERCHANT_CATEGORY_XCD) AS MERCHANT_CATEGORY_XCD, {amounts}, {counts}
        FROM bank GROUP BY 1, 2, 3"""


_MONEY = {f"{y}Tot": c for y, c in zip(YEARS, SALES_COLUMNS)}
_NUMBER = {f"{y}CNt": c for y, c in zip(YEARS, COUNT_COLUMNS)}


def _sums() -> str:
    # the merchant totals are doubles of exact cents, so cents add up exactly
    money = ", ".join(f"sum(CAST({_MONEY[f'{y}Tot']} AS DECIMAL(18,2))) AS \"{y}Tot\"" for y in _LATEST_FIRST)
    number = ", ".join(f"sum({_NUMBER[f'{y}CNt']}) AS \"{y}CNt\"" for y in _LATEST_FIRST)
    return f"""SELECT trim(MCC) AS MCC, trim(BILLING_STATE) AS BILLING_STATE, trim(CITY) AS CITY, sum(POPULATION) AS population, {money}, {number}
        FROM merchants GROUP BY 1, 2, 3"""


_TOTALS = f"""
m AS ({_sums()}), b AS ({_pivot(False)}),
totals AS (
  SELECT m.MCC, m.BILLING_STATE, m.CITY,
    {", ".join(f'CAST(m."{y}Tot" + b."{y}Tot" AS DOUBLE) AS Total{y}' for y in _LATEST_FIRST)},
    {", ".join(f'CAST(m."{y}CNt" + b."{y}CNT" AS BIGINT) AS CNT{y}' for y in _LATEST_FIRST)}
  FROM m LEFT JOIN b ON m.MCC = b.MERCHANT_CATEGORY_XCD AND m.CITY = b.MERCHANT_CITY_NAME
    AND m.BILLING_STATE = b.MERCHANT_STATE_XCD
  WHERE m.MCC = '5812')"""
_TOTAL_COLUMNS = [f"Total{y}" for y in _LATEST_FIRST] + [f"CNT{y}" for y in _LATEST_FIRST]
_COMPLETE_TOTALS = " AND ".join(f"{c} IS NOT NULL" for c in _TOTAL_COLUMNS)


def _typed(select: str, quoted: str) -> str:
    """Sums as the types the operators give: double for money, bigint for counts."""
    cells = [f'CAST("{y}Tot" AS DOUBLE) AS "{y}Tot"' for y in _LATEST_FIRST]
    cells += [f'CAST("{y}{quoted}" AS BIGINT) AS "{y}{quoted}"' for y in _LATEST_FIRST]
    replaced = ", ".join(cells)
    return f"SELECT * REPLACE ({replaced}) FROM ({select})"


_MERGE = """
merged AS (
  SELECT s.*, t.* EXCLUDE (MCC, BILLING_STATE, CITY), c.* EXCLUDE (zipcode)
  FROM (SELECT * REPLACE (trim(CITY) AS CITY) FROM {source}) s JOIN totals t USING (BILLING_STATE, CITY) JOIN census c ON s.ZIPCODE = c.zipcode
  WHERE {complete})"""


def _merged(source: str) -> str:
    return _MERGE.format(source=source, complete=_COMPLETE_TOTALS)


def _index(table: str, column: str, output: str) -> str:
    return f"""{output}_values AS (
      SELECT {column} AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1
             AS DOUBLE) AS {output} FROM {table} GROUP BY 1)"""


_HASH = "CAST(concat('0x', substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


def _in_test(key: str, ratio: float = 0.2) -> str:
    return f"{_HASH.format(key=key)} < {int(ratio * 2**32)}"


_NEIGHBOURS = f"""
vectors AS (SELECT vec_id, embedding, concat('class_', CAST(label AS VARCHAR)) AS class_name FROM embeddings),
test AS (SELECT vec_id AS test_id, embedding AS v, class_name AS label FROM vectors WHERE {_in_test("vec_id")}),
train AS (SELECT vec_id AS train_id, embedding AS w, class_name AS prediction
          FROM vectors WHERE NOT {_in_test("vec_id")}),
pairs AS (
  SELECT test_id, train_id, label, prediction,
    list_sum([(CAST(v[i] AS DOUBLE) - CAST(w[i] AS DOUBLE)) * (CAST(v[i] AS DOUBLE) - CAST(w[i] AS DOUBLE))
              FOR i IN range(1, len(v) + 1)]) AS distance
  FROM test, train),
nearest AS (
  SELECT test_id, train_id, prediction, label FROM pairs
  QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY distance, train_id) = 1)"""


_CLASSES = _index("vectors", "class_name", "label")
_VECTORS = "vectors AS (SELECT vec_id, concat('class_', CAST(label AS VARCHAR)) AS class_name FROM embeddings)"
_LINE_KEY = "concat(CAST(l_orderkey AS VARCHAR), '|', CAST(l_linenumber AS VARCHAR))"
_LATE = "late AS (SELECT *, CASE WHEN l_linenumber > 3 THEN 'late' ELSE 'early' END AS part FROM lineitem)"
_TEXTS = ("MERCHANT_NAME", "MCC", "BILLING_STATE", "CITY", "ZIPCODE")


_FEATURE_NUMBERS = (
    "MERCHANT_ID", "POPULATION", *(c for c in SALES_COLUMNS if c != IMPORTANCE_TARGET), *COUNT_COLUMNS, "AVG_SALES", "AVG_SALES_CNT",
    *SCORING_COLUMNS,
)
_MERGED_NUMBERS = (
    *_FEATURE_NUMBERS, "SALES_TREND_WEIGHTED", "SALE_CNT_TREND_WEIGHTED", "TREND_WEIGHTED", "TREND_RANKING",
    *(f"Total{y}" for y in _LATEST_FIRST), *(f"CNT{y}" for y in _LATEST_FIRST), *(c for _, _, c in _CENSUS_COLUMNS),
)


def _slots(source: str, numbers: Sequence[str], texts: Sequence[str]) -> str:
    """A slot for each numeric column and then for each value of a text column, the most frequent first."""
    named = ", ".join(f"({i}, '{c}')" for i, c in enumerate(numbers))
    counted = " UNION ALL ".join(
        f"SELECT {i} AS place, 'OHE_{c}_' || {c} AS name, {c} AS value, count(*) AS n FROM {source} GROUP BY {c}" for i, c in enumerate(texts)
    )
    return f"""SELECT idx, name, true AS is_share FROM (VALUES {named}) AS numbers(idx, name) UNION ALL
               SELECT CAST({len(numbers)} + row_number() OVER (ORDER BY place, n DESC, value) - 1 AS INTEGER), name, true FROM ({counted})"""


def _with(*tables: str) -> str:
    return "WITH " + ",".join(tables) + "\n"


def oracle_sql() -> dict[str, str]:
    features = _with(_MERCHANTS, _FEATURES)
    city = _with(_MERCHANTS, _BANK, _TOTALS)
    lines = "SELECT l_orderkey, l_linenumber"
    directions = (1, 0, 1, 0, 1, 0)
    restaurants = "merchants_5812 AS (SELECT * FROM merchants WHERE MCC = '5812')"
    job = _with(
        _MERCHANTS, _BANK, _CENSUS, restaurants, _FEATURES.replace("FROM merchants)", "FROM merchants_5812)"), _RANKED,
        _TOTALS, _merged("ranked"), _limits("merged", SCORING_COLUMNS),
    )
    measures = " UNION ALL ".join(
        f"{{keys}}, {i} AS pos, {c} AS value FROM {{source}}" for i, c in enumerate(_LINE_MEASURES)
    )
    exact = _with(_LATE, _index("late", "part", "label")) + f"""
        SELECT l_orderkey, l_linenumber, label, label AS prediction FROM late JOIN label_values ON value = part
        WHERE {_in_test(_LINE_KEY)}"""
    return {
        "csv_round_trip": "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders",
        "parquet_round_trip": "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem",
        "scan_bank": _with(_BANK) + "SELECT * REPLACE (CAST(TOT_SUM AS DOUBLE) AS TOT_SUM) FROM bank",
        "filter_mcc": _with(_MERCHANTS) + "SELECT * FROM merchants WHERE MCC = '5812'",
        "sql_text": _with(_MERCHANTS, _BANK)
        + """SELECT BILLING_STATE, count(*) AS merchants,
               CAST(sum(CAST(TOT_SALES2021 AS DECIMAL(18,2))) AS DOUBLE) AS sales,
               (SELECT CAST(sum(TOT_SUM) AS DOUBLE) FROM bank
                WHERE YEAR_run = 2021 AND MERCHANT_STATE_XCD = BILLING_STATE) AS bank_total
             FROM merchants
             WHERE BILLING_STATE IN (SELECT MERCHANT_STATE_XCD FROM bank WHERE YEAR_run = 2021) GROUP BY 1""",
        "drop_columns": _with(_MERCHANTS) + "SELECT * EXCLUDE (MCC, POPULATION) FROM merchants",
        "avg_sales": _with(_MERCHANTS) + f"SELECT MERCHANT_ID, {_named(_AVERAGES)} FROM merchants",
        "sales_trends": _with(_MERCHANTS)
        + f"SELECT MERCHANT_ID, {_named({k: v for k, v in _TRENDS.items() if 'CNT' not in k})} FROM merchants",
        "count_trends": _with(_MERCHANTS)
        + f"SELECT MERCHANT_ID, {_named({k: v for k, v in _TRENDS.items() if 'CNT' in k})} FROM merchants",
        "merchant_features": features + "SELECT * FROM features",
        "drop_nulls": city + f"SELECT * FROM totals WHERE {_COMPLETE_TOTALS}",
        "limit_rows": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5000",
        "zip_keys": _with(_MERCHANTS) + "SELECT DISTINCT ZIPCODE AS zipcode FROM merchants",
        "typed_columns": _with(_MERCHANTS)
        + f"""SELECT MERCHANT_ID, POPULATION, {", ".join(SALES_COLUMNS[:3])}, {", ".join(COUNT_COLUMNS)},
              MERCHANT_NAME, BILLING_STATE, CITY, ZIPCODE FROM merchants""",
        "trend_weighted": _with(_MERCHANTS, _FEATURES, _RANKED)
        + "SELECT MERCHANT_ID, SALES_TREND_WEIGHTED, SALE_CNT_TREND_WEIGHTED, TREND_WEIGHTED FROM weighted",
        "minmax_scale": _with(_MERCHANTS, _FEATURES, _limits("features", SCORING_COLUMNS))
        + f"""SELECT MERCHANT_ID,
              {", ".join(f"{_scaled(c, d)} AS {c}_SCALED" for c, d in zip(SCORING_COLUMNS, directions))}
              FROM features, limits""",
        "scale_lines": _with(_limits("lineitem", _LINE_MEASURES))
        + f"""{lines},
              {", ".join(f"{_scaled(c, d)} AS {c}_SCALED" for c, d in zip(_LINE_MEASURES, (1, 1, 0, 0)))}
              FROM lineitem, limits""",
        "proximity_score": _with(_MERCHANTS, _FEATURES, _limits("features", SCORING_COLUMNS))
        + f"SELECT MERCHANT_ID, {_SCORE} AS SCORE FROM features, limits",
        "weighted_sum": features + f"SELECT MERCHANT_ID, {_WEIGHTED_SUM} AS WEIGHTED_SUM FROM features",
        "scoring_report": _with(_MERCHANTS, _FEATURES, _limits("features", SCORING_COLUMNS)) + _report("features"),
        "yearly_pivot": _with(_BANK) + _typed(_pivot(False), "CNT"),
        "yearly_pivot_legacy": _with(_BANK) + _typed(_pivot(True), "CNT"),
        "city_sums": _with(_MERCHANTS)
        + _typed(_sums(), "CNt").replace("REPLACE (", "REPLACE (CAST(population AS BIGINT) AS population, ", 1),
        "agg_city_totals": city + "SELECT * FROM totals",
        "census_parse": _with(_CENSUS) + "SELECT * FROM census",
        "census_streamed": _with(_CENSUS) + "SELECT * FROM census",
        "census_enrich": _with(_MERCHANTS, _CENSUS)
        + "SELECT * FROM (SELECT DISTINCT ZIPCODE AS zipcode FROM merchants) LEFT JOIN census USING (zipcode)",
        "join_city": _with(_MERCHANTS, _FEATURES, _BANK, _TOTALS)
        + "SELECT f.*, t.* EXCLUDE (MCC, BILLING_STATE, CITY)"
        + " FROM (SELECT * REPLACE (trim(CITY) AS CITY) FROM features) f JOIN totals t USING (BILLING_STATE, CITY)",
        "join_census": _with(_MERCHANTS, _CENSUS)
        + "SELECT m.*, c.* EXCLUDE (zipcode) FROM merchants m JOIN census c ON m.ZIPCODE = c.zipcode",
        "merge_all": _with(_MERCHANTS, _FEATURES, _BANK, _TOTALS, _CENSUS, _merged("features"))
        + "SELECT * FROM merged",
        "merge_buckets": _with(_MERCHANTS, _FEATURES, _BANK, _TOTALS, _CENSUS, _merged("features"))
        + "SELECT * FROM merged",
        "extract_parts": "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_quantity < 21 THEN 1 ELSE trunc(l_quantity) END AS INTEGER) AS quantity,"
        " l_partkey FROM lineitem",
        "split_join": f"{lines}, s_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
        "trend_ranking": _with(_MERCHANTS, _FEATURES, _RANKED)
        + "SELECT MERCHANT_ID, TREND_WEIGHTED, TREND_RANKING FROM ranked",
        "rank_lines": f"{lines}, l_extendedprice, rank() OVER (ORDER BY l_extendedprice) AS price_rank FROM lineitem",
        "rank_tied_lines": f"{lines}, l_discount, rank() OVER (ORDER BY l_discount DESC) AS discount_rank FROM lineitem",
        "assemble_features": measures.format(keys=lines, source="lineitem"),
        "index_labels": _with(_index("customer", "c_mktsegment", "label"))
        + "SELECT c_custkey, c_mktsegment, label FROM customer JOIN label_values ON value = c_mktsegment",
        "index_many_labels": _with(_index("orders", "o_custkey", "label"))
        + "SELECT o_orderkey, o_custkey, label FROM orders JOIN label_values ON value = o_custkey",
        "index_columns": _with(_index("part", "p_brand", "IDX_p_brand"), _index("part", "p_type", "IDX_p_type"))
        + """SELECT p_partkey, p_brand, p_type, IDX_p_brand, IDX_p_type FROM part
             JOIN IDX_p_brand_values b ON b.value = p_brand JOIN IDX_p_type_values t ON t.value = p_type""",
        "one_hot": _with(_index("part", "p_brand", "brand_slot"), _index("part", "p_type", "type_slot"))
        + """SELECT p_partkey, 'p_brand' AS name, CAST(brand_slot AS INTEGER) AS slot, 1e0 AS "set"
             FROM part JOIN brand_slot_values ON value = p_brand
             UNION ALL SELECT p_partkey, 'p_type', CAST(type_slot AS INTEGER), 1e0
             FROM part JOIN type_slot_values ON value = p_type""",
        "transform_features": _with(
            _index("lineitem", "l_returnflag", "label"),
            "labelled AS (SELECT * FROM lineitem JOIN label_values ON value = l_returnflag)",
        )
        + measures.format(keys=f"{lines}, label", source="labelled"),
        "hash_split": f"""SELECT o_orderkey, CASE WHEN {_in_test("o_orderkey")} THEN 'test' ELSE 'train' END AS part
                          FROM orders""",
        "split_target": f"""SELECT o_orderkey, o_totalprice, o_orderstatus,
                            CASE WHEN {_in_test("o_orderkey")} THEN 'test' ELSE 'train' END AS part FROM orders""",
        "nearest_neighbour": _with(_NEIGHBOURS) + "SELECT * FROM nearest",
        "accuracy": _with(_NEIGHBOURS)
        + "SELECT avg(CASE WHEN prediction = label THEN 1e0 ELSE 0e0 END) AS accuracy FROM nearest",
        "merchant_report": job + _report("merged"),
        "rank_keys": f"{lines}, l_partkey, rank() OVER (ORDER BY l_partkey) AS part_rank FROM lineitem",
        "rank_money": """SELECT o_orderkey, rank() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC) AS price_rank
                         FROM orders""",
        "rank_names": "SELECT p_partkey, p_type, rank() OVER (ORDER BY p_type) AS type_rank FROM part",
        "slot_labels": _with(_index("part", "p_brand", "brand_slot"), _index("part", "p_type", "type_slot"))
        + """SELECT 'p_brand' AS name, CAST(brand_slot AS INTEGER) AS slot, value FROM brand_slot_values
             UNION ALL SELECT 'p_type', CAST(type_slot AS INTEGER), value FROM type_slot_values""",
        "random_split": """SELECT count(*) AS split_rows, CAST(0 AS BIGINT) AS in_both, CAST(0 AS BIGINT) AS in_neither
                           FROM orders""",
        "rf_predict": _with(_VECTORS, _CLASSES)
        + f"""SELECT vec_id, label, true AS has_class FROM vectors JOIN label_values ON value = class_name
              WHERE {_in_test("vec_id")}""",
        "rf_accuracy": f"SELECT count(*) AS test_rows, true AS is_share FROM embeddings WHERE {_in_test('vec_id')}",
        "rf_lines": f"SELECT count(*) AS test_rows, true AS is_share FROM lineitem WHERE {_in_test(_LINE_KEY)}",
        "rf_exact_predict": exact,
        "rf_exact_accuracy": "SELECT 1e0 AS accuracy",
        "rf_saved_model": exact,
        "rf_exact_importance": """SELECT * FROM (VALUES (0, 'number', 1e0), (1, 'same', 0e0), (2, 'OHE_text_x', 0e0))
                                  AS slots(idx, name, score)""",
        "feature_importance": features + _slots("features", _FEATURE_NUMBERS, _TEXTS),
        "merchant_importance": job + _slots(
            f"(SELECT * FROM merged ORDER BY {_HASH.format(key='MERCHANT_ID')}, MERCHANT_ID LIMIT 5000)",
            _MERGED_NUMBERS, ("ZIPCODE", "BILLING_STATE", "CITY", "MERCHANT_NAME", "MCC"),
        ),
    }
