"""Oracle SQL (DuckDB dialect) restating each catalogued query on the driver tables.

The oracle goes straight to the driver columns (no JSON), so it checks the
whole path: documents are built, parsed, joined and aggregated by Spark, while
the SQL computes the same answer from the raw tables. Surrogate ids are
restated with ``row_number()`` in natural-key order (how a first load numbers
them). These fragments mirror :mod:`starmart.plans.landing`.
"""

NS = "(SELECT count(*) FROM supplier)"
U_TS = "(TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER)))"
S_TS = "(TIMESTAMP '1995-01-01' + to_days(CAST(s_suppkey % 1000 AS INTEGER)))"
STATUS = "(CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'CANCELLED' END)"
COST = "CAST(l_extendedprice AS DECIMAL(14,2))"
FMT = "'%Y-%m-%d %H:%M:%S'"

R_SK = (f"r_sk AS (SELECT CAST(s_suppkey AS VARCHAR) restaurant_nk, s_name restaurant_name, {S_TS} active_from, "
        "row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) id FROM supplier)")
C_SK = ("c_sk AS (SELECT CAST(n_nationkey AS VARCHAR) courier_nk, n_name courier_name, "
        "row_number() OVER (ORDER BY CAST(n_nationkey AS VARCHAR)) id FROM nation)")
U_SK = ("u_sk AS (SELECT CAST(c_custkey AS VARCHAR) user_nk, "
        "row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) id FROM customer)")
T_SK = ("t_sk AS (SELECT ts, row_number() OVER (ORDER BY ts) id FROM (SELECT DISTINCT o_orderdate ts FROM orders))")
# delivered orders (every order that is not OPEN has exactly one delivery)
D = (f"d AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) order_key, o_orderdate, o_orderstatus, "
     f"CAST(c_nationkey AS VARCHAR) courier_nk, CAST(1 + o_orderkey % 5 AS SMALLINT) rate, "
     f"CAST(o_orderkey % 200 AS DECIMAL(14,2)) tip_sum, CAST(o_orderkey % {NS} AS VARCHAR) restaurant_nk, "
     f"CAST(o_custkey AS VARCHAR) user_nk "
     f"FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'O')")
O_SK = "o_sk AS (SELECT o_orderkey, row_number() OVER (ORDER BY order_key) id FROM d)"
P_SK = (f"p_sk AS (SELECT p.p_partkey, row_number() OVER (ORDER BY r.id, CAST(p.p_partkey AS VARCHAR)) id "
        f"FROM part p JOIN r_sk r ON r.restaurant_nk = CAST(p.p_partkey % {NS} AS VARCHAR))")
# product sales at (product, order) grain, rounded once when stored
FCT = (f"fct AS (SELECT l_partkey, l_orderkey, CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) count, "
       f"CAST(sum({COST}) AS DECIMAL(14,2)) price, CAST(sum({COST}) AS DECIMAL(14,2)) total_sum, "
       f"CAST(sum({COST} * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(14,2)) bonus_payment, "
       f"CAST(sum({COST} * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(14,2)) bonus_grant "
       f"FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O') "
       f"GROUP BY l_partkey, l_orderkey)")
# payment lines as staged (scale 5 values)
PAY = (f"pay AS (SELECT CAST(l_orderkey AS VARCHAR) order_id, CAST(l_partkey AS VARCHAR) product_id, "
       f"CAST(l_quantity AS INTEGER) count, CAST({COST} AS DECIMAL(19,5)) price, "
       f"CAST({COST} AS DECIMAL(19,5)) total_sum, "
       f"CAST({COST} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(19,5)) bonus_payment, "
       f"CAST({COST} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(19,5)) bonus_grant, l_orderkey FROM lineitem)")

BANDS = ("CASE WHEN {r} < 4 THEN greatest({t} * 0.05, 100) "
         "WHEN 4 <= {r} AND {r} < 4.5 THEN greatest({t} * 0.07, 150) "
         "WHEN 4.5 <= {r} AND {r} < 4.9 THEN greatest({t} * 0.08, 175) "
         "WHEN 4.9 <= {r} THEN greatest({t} * 0.1, 200) END")


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def order_doc(id_expr: str = "CAST(o_orderkey AS VARCHAR)") -> str:
    return (f"json_object('_id', {id_expr}, 'final_status', {STATUS}, 'date', strftime(o_orderdate, {FMT}), "
            f"'user', json_object('id', CAST(o_custkey AS VARCHAR)), "
            f"'restaurant', json_object('id', CAST(o_orderkey % {NS} AS VARCHAR)), "
            f"'update_ts', strftime(o_orderdate, {FMT}))::VARCHAR")


SETTLEMENT = with_(R_SK, FCT) + f"""
, o AS (SELECT o_orderkey, CAST(o_orderkey % {NS} AS VARCHAR) restaurant_nk, CAST(o_orderdate AS DATE) d
        FROM orders WHERE o_orderstatus = 'F')
, g AS (SELECT r.id rid, r.restaurant_name, o.d, count(DISTINCT o.o_orderkey) n, sum(f.total_sum) t,
               sum(f.bonus_payment) bp, sum(f.bonus_grant) bg
        FROM fct f JOIN o ON f.l_orderkey = o.o_orderkey JOIN r_sk r ON r.restaurant_nk = o.restaurant_nk
        GROUP BY 1, 2, 3)
SELECT CAST(rid AS BIGINT) restaurant_id, restaurant_name, d settlement_date, CAST(n AS INTEGER) orders_count,
       CAST(t AS DECIMAL(14,2)) orders_total_sum, CAST(bp AS DECIMAL(14,2)) orders_bonus_payment_sum,
       CAST(bg AS DECIMAL(14,2)) orders_bonus_granted_sum, CAST(t * 0.25 AS DECIMAL(14,2)) order_processing_fee,
       CAST(t - t * 0.25 - bp AS DECIMAL(14,2)) restaurant_reward_sum
FROM g"""

_LEDGER_TAIL = """
SELECT CAST(cid AS BIGINT) courier_id, courier_name, CAST(y AS SMALLINT) settlement_year,
       CAST(m AS SMALLINT) settlement_month, CAST(n AS INTEGER) orders_count, CAST(t AS DECIMAL(14,2)) orders_total_sum,
       CAST(round(ra) AS SMALLINT) rate_avg, CAST(t * 0.25 AS DECIMAL(14,2)) order_processing_fee,
       CAST(os AS DECIMAL(14,2)) courier_order_sum, CAST(ts AS DECIMAL(14,2)) courier_tips_sum,
       CAST(os + ts * 0.95 AS DECIMAL(14,2)) courier_reward_sum
FROM g"""

LEDGER_ROW_RATE = with_(C_SK, FCT, D) + f"""
, g AS (SELECT c.id cid, c.courier_name, year(d.o_orderdate) y, month(d.o_orderdate) m,
               count(DISTINCT d.o_orderkey) n, sum(f.total_sum) t, avg(d.rate) ra,
               sum({BANDS.format(r='d.rate', t='f.total_sum')}) os, sum(d.tip_sum) ts
        FROM fct f JOIN d ON f.l_orderkey = d.o_orderkey JOIN c_sk c ON c.courier_nk = d.courier_nk
        WHERE d.o_orderstatus = 'F' GROUP BY 1, 2, 3, 4)""" + _LEDGER_TAIL

LEDGER_AVG_RATE = with_(C_SK, FCT, D) + f"""
, po AS (SELECT c.id cid, c.courier_name, year(d.o_orderdate) y, month(d.o_orderdate) m, d.o_orderkey,
                d.rate, d.tip_sum, CAST(sum(f.total_sum) AS DECIMAL(18,2)) tot
         FROM fct f JOIN d ON f.l_orderkey = d.o_orderkey JOIN c_sk c ON c.courier_nk = d.courier_nk
         WHERE d.o_orderstatus = 'F' GROUP BY 1, 2, 3, 4, 5, 6, 7)
, g0 AS (SELECT cid, courier_name, y, m, count(DISTINCT o_orderkey) n, CAST(sum(tot) AS DECIMAL(18,2)) t, avg(rate) ra, sum(tip_sum) ts
         FROM po GROUP BY 1, 2, 3, 4)
, p AS (SELECT po.cid, po.y, po.m, sum({BANDS.format(r='g0.ra', t='po.tot')}) os
        FROM po JOIN g0 ON po.cid = g0.cid AND po.y = g0.y AND po.m = g0.m GROUP BY 1, 2, 3)
, g AS (SELECT g0.*, p.os FROM g0 JOIN p ON g0.cid = p.cid AND g0.y = p.y AND g0.m = p.m)""" + _LEDGER_TAIL
