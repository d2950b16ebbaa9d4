"""The named queries as SQL on the test tables.

Each is built from named relations (CTEs); a query lists the ones it starts from
and gets those they need. Written apart from the operators: the state of the
source is folded from the change log, merges are full outer joins.
"""

from __future__ import annotations

import re

from orderflow.plans.sample_tables import BEFORE_DELETES, FIRST, SECOND

_ORDERS = (
    "salesorderid, productid, orderdate, productname, postalcode, productorderqty, "
    "productsales, orderupdatedtm, src_cdt_batch_id, deleted_flg"
)
_STAGING = (
    "salesorderid, productid, orderdate, productname, postalcode, productorderqty, "
    "productsales, sys_change_op, orderupdatedtm, src_cdt_batch_id"
)
_VALUES = ("orderdate", "productname", "postalcode", "productorderqty", "productsales")

_CHANGE_LOG = """
select o_orderkey as salesorderid, cast(1 + o_orderkey % 50 as bigint) as ver, 'I' as op from orders
union all
select o_orderkey, cast(60 + o_orderkey % 20 as bigint), 'U' from orders where o_orderkey % 4 = 0
union all
select o_orderkey, cast(90 + floor((o_orderkey % 100) / 10) as bigint), 'D'
from orders where o_orderkey % 10 = 0
"""


def _net(since: int, until: int | None) -> str:
    upper = "" if until is None else f" and ver <= {until}"
    return f"""
select salesorderid,
  case when max(case when ver = mx then op end) = 'D' then 'D'
       when count(case when op = 'I' then 1 end) > 0 then 'I' else 'U' end as sys_change_op
from (select *, max(ver) over (partition by salesorderid) as mx from clog
      where ver > {since}{upper}) z
group by salesorderid"""


def _header(until: int) -> str:
    return f"""
select o.o_orderkey as salesorderid, o.o_custkey as shiptoaddressid, o.o_orderdate as orderdate,
  o.o_orderdate + interval '1' hour * cast(o.o_orderkey % 24 as int)
                + interval '1' day * cast(x.u as int) as modifieddate,
  x.u as upd
from orders o join (
  select salesorderid, max(case when op = 'U' then 1 else 0 end) as u,
         max(case when op = 'D' then 1 else 0 end) as d
  from clog where ver <= {until} group by salesorderid) x on x.salesorderid = o.o_orderkey
where x.d = 0"""


def _detail(hdr: str) -> str:
    return f"""
select l_orderkey as salesorderid, l_partkey as productid,
  cast(l_quantity as int) + h.upd as orderqty,
  cast(round(l_extendedprice * (1 - l_discount), 4) as decimal(18,4)) as linetotal
from lineitem join {hdr} h on l_orderkey = h.salesorderid"""


def _capture(n: str, batch: int) -> str:
    return f"""
select n.salesorderid, n.sys_change_op, h.orderdate as "OrderDate",
  h.modifieddate as orderupdatedtm, d.productid as "ProductID", p.p_name as productname,
  lpad(cast(c.c_nationkey as varchar(10)), 5, '0') as "PostalCode",
  d.orderqty as productorderqty, d.linetotal as productsales,
  cast({batch} as bigint) as job_exec_id
from net{n} n left join hdr{n} h on n.salesorderid = h.salesorderid
  left join det{n} d on n.salesorderid = d.salesorderid
  left join part p on d.productid = p.p_partkey
  left join customer c on h.shiptoaddressid = c.c_custkey"""


def _staged(n: str) -> str:
    return f"""
select salesorderid, "ProductID" as productid, cast("OrderDate" as date) as orderdate,
  productname, "PostalCode" as postalcode, cast(productorderqty as bigint) as productorderqty,
  cast(productsales as double) as productsales, sys_change_op, orderupdatedtm,
  job_exec_id as src_cdt_batch_id
from cap{n}"""


def _preagg(staged: str) -> str:
    return f"""
select salesorderid, productid, orderdate, productname, postalcode,
  cast(sum(productorderqty) as bigint) as productorderqty,
  cast(sum(cast(productsales as decimal(28,6))) as double) as productsales,
  sys_change_op, orderupdatedtm, src_cdt_batch_id
from {staged}
group by salesorderid, productid, orderdate, productname, postalcode, sys_change_op,
  orderupdatedtm, src_cdt_batch_id"""


def _reference_updated(everything: bool) -> str:
    """Columns of a target row ``a`` matched by ``b``; with ``everything``, also
    of rows on one side only."""
    hit = "b.salesorderid is not null"
    cols = ["salesorderid", "productid"]
    out = [f"coalesce(a.{c}, b.{c}) as {c}" for c in cols] if everything else [
        f"a.{c} as {c}" for c in cols
    ]
    new = "a.salesorderid is null"
    for c in _VALUES:
        out.append(
            f"case when {new} then b.{c} when {hit} and b.sys_change_op <> 'D' then b.{c} "
            f"else a.{c} end as {c}"
        )
    for c in ("orderupdatedtm", "src_cdt_batch_id"):
        out.append(f"case when {hit} then b.{c} else a.{c} end as {c}")
    out.append(
        f"cast(case when {new} then 0 when {hit} and b.sys_change_op = 'D' then 1 "
        f"when {hit} then 0 else a.deleted_flg end as int) as deleted_flg"
    )
    return ", ".join(out)


def _merge_reference(target: str, source: str) -> str:
    return f"""
select {_reference_updated(True)}
from {target} a full outer join {source} b
  on a.salesorderid = b.salesorderid and a.productid = b.productid"""


def _merge_matched(target: str, source: str) -> str:
    return f"""
select {_reference_updated(False)}
from {target} a join {source} b
  on a.salesorderid = b.salesorderid and a.productid = b.productid"""


def _as_new(source: str) -> str:
    """A source merged into an empty table by the reference rules."""
    columns = _ORDERS.replace("deleted_flg", "cast(0 as int) as deleted_flg")
    return f"select {columns} from {source}"


def _merge(target: str, source: str) -> str:
    """The repaired merge: verdict per order, then a full outer join by line."""
    values = ", ".join(
        f"case when b.salesorderid is not null and (b.d = 0 or a.salesorderid is null) "
        f"then b.{c} else a.{c} end as {c}"
        for c in _VALUES
    )
    return f"""
select coalesce(a.salesorderid, b.salesorderid) as salesorderid,
  coalesce(a.productid, b.productid) as productid, {values},
  case when b.salesorderid is not null then b.orderupdatedtm else a.orderupdatedtm end
    as orderupdatedtm,
  coalesce(a.delete_batch, b.src_cdt_batch_id, a.src_cdt_batch_id) as src_cdt_batch_id,
  cast(case when a.delete_batch is not null then 1 when b.salesorderid is not null then b.d
       else a.deleted_flg end as int) as deleted_flg
from (select t.*, v.batch as delete_batch from {target} t
      left join (select * from verdict_{target}_{source} where d = 1) v
      on t.salesorderid = v.salesorderid) a
  full outer join (
    select s.{_STAGING.replace(', ', ', s.')}, v.d
    from {source} s join verdict_{target}_{source} v on s.salesorderid = v.salesorderid
    where v.d = 0 or (s.productid is not null and exists (
      select 1 from {target} t where t.salesorderid = s.salesorderid
        and t.productid = s.productid))
    union all
    select salesorderid, null, null, null, null, null, null, 'D', null, batch, 1
    from verdict_{target}_{source} where d = 1 and not known) b
  on a.salesorderid = b.salesorderid and a.productid is not distinct from b.productid"""


def _verdict(target: str, source: str) -> str:
    return f"""
select s.salesorderid, s.batch, s.d, t.salesorderid is not null as known
from (select salesorderid, max(src_cdt_batch_id) as batch,
        max(case when sys_change_op = 'D' then 1 else 0 end) as d
      from {source} group by salesorderid) s
  left join (select salesorderid, max(src_cdt_batch_id) as batch
             from {target} group by salesorderid) t on s.salesorderid = t.salesorderid
where t.salesorderid is null or s.batch >= t.batch"""


def _summary(orders: str) -> str:
    return f"""
select orderdate, cast(hour(orderupdatedtm) as int) as orderhour, productid, productname,
  postalcode, cast(sum(productorderqty) as bigint) as productsalesvolume,
  cast(sum(cast(productsales as decimal(28,6))) as double) as productsales
from {orders} where deleted_flg = 0
group by orderdate, hour(orderupdatedtm), productid, productname, postalcode"""


def _relations() -> dict[str, str]:
    rel = {"clog": _CHANGE_LOG}
    # Batches: 1 and 2, and 3 = batch 2 while deleted orders still have lines.
    for n, batch, span, state in (
        ("1", 1, FIRST, FIRST[1]),
        ("2", 2, SECOND, SECOND[1]),
        ("3", 2, SECOND, BEFORE_DELETES),
    ):
        rel[f"net{n}"] = _net(*span)
        rel[f"hdr{n}"] = _header(state)
        rel[f"det{n}"] = _detail(f"hdr{n}")
        rel[f"cap{n}"] = _capture(n, batch)
        rel[f"stg{n}"] = _staged(n)
        rel[f"agg{n}"] = _preagg(f"stg{n}")
    rel["stgboth"] = "select * from agg1 union all select * from agg2"
    rel["latest"] = """
select * from stgboth
qualify src_cdt_batch_id = max(src_cdt_batch_id) over (partition by salesorderid)"""
    rel["empty"] = "select * from after1 where 1 = 0"
    rel["after1"] = _as_new("agg1")  # batch 1 holds inserts only
    for target, source in (
        ("after1", "agg2"),
        ("after1", "agg3"),
        ("empty", "agg2"),
        ("only2", "agg1"),
        ("empty", "latest"),
    ):
        rel[f"verdict_{target}_{source}"] = _verdict(target, source)
        rel[f"merged_{target}_{source}"] = _merge(target, source)
    rel["only2"] = "select * from merged_empty_agg2"
    rel["led"] = """
select event_id as job_exec_id,
  cast(case when event_type = 'error' then null else 0 end as int) as job_exec_status,
  event_id * 10 as db_chg_version_id, ts as job_start_ts,
  case when event_type = 'error' then null else ts + interval '5' minute end as job_end_ts
from events"""
    rel["elog"] = """
select user_id as salesorderid, event_id as version,
  case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as op,
  ts as changed_at
from events"""
    rel["person"] = """
select c_mktsegment as firstname, c_name as lastname, c_custkey as businessentityid
from orders join customer on o_custkey = c_custkey"""
    rel["paddr"] = """
select c_mktsegment as addressline1, n_name as city,
  lpad(cast(c_nationkey as varchar(10)), 5, '0') as postalcode
from customer join nation on c_nationkey = n_nationkey"""
    return rel


def _with(relations: dict[str, str], query: str) -> str:
    """The query with the relations it needs, each after those it needs."""
    placed: list[str] = []

    def place(sql: str) -> None:
        for word in re.findall(r"\w+", sql):
            if word in relations and word not in placed:
                place(relations[word])
                placed.append(word)

    place(query)
    if not placed:
        return query
    return "with " + ",\n".join(f"{n} as ({relations[n]})" for n in placed) + "\n" + query


def _text(column: str, alias: str) -> str:
    return f'cast({column} as varchar) as "{alias}"'


_CAPTURED = """salesorderid, sys_change_op, "OrderDate", orderupdatedtm, "ProductID", productname,
  "PostalCode", productorderqty, cast(productsales as double) as productsales, job_exec_id"""
_NOW = "cast('2025-01-01 12:00:00' as timestamp)"


def oracle_queries() -> dict[str, str]:
    merged = f"select {_ORDERS} from merged_after1_agg2"
    wire = ", ".join(
        _text(f'"{c}"' if c[0].isupper() else c, c)
        for c in (
            "salesorderid", "sys_change_op", "OrderDate", "orderupdatedtm", "ProductID",
            "productname", "PostalCode", "productorderqty", "productsales", "job_exec_id",
        )
    )
    domains = "\nunion\n".join(
        f"select '{c}' as domain, cast({c} as varchar) as value from {t}"
        for t, columns in (
            ("person", ("firstname", "lastname", "businessentityid")),
            ("paddr", ("addressline1", "city", "postalcode")),
        )
        for c in columns
    )
    sql = {
        "net_changes_since": _net(SECOND[0], None),
        "net_changes_between": _net(30, 95),
        "net_changes_of_log": _net(*SECOND),
        "net_changes_of_keys": _net(SECOND[0], None),
        "net_changes_after_mark": _net(0, None).replace("from clog\n", """from
            (select * from clog where ver > (select db_chg_version_id from led
              where job_exec_status = 0 and db_chg_version_id between 40 and 69
              order by job_end_ts desc, db_chg_version_id desc limit 1))\n"""),
        "newest_version_of_log": "select max(ver) as version from clog",
        "cleaned_log": """select * from elog where version // 100 >= (
            select min(part) from (select version // 100 as part from elog group by 1
              having max(changed_at) >= (select max(changed_at) from elog) - interval '3' day
                or part = (select max(version // 100) from elog)))""",
        "current_version": "select coalesce(max(ver), 0) as version from clog",
        "change_log_retention": """select * from elog
            where changed_at >= (select max(changed_at) from elog) - interval '3' day""",
        "min_valid_version": """select coalesce(max(version), 0) as version from elog
            where changed_at < (select max(changed_at) from elog) - interval '3' day""",
        "join_changes_header": """select n.salesorderid, n.sys_change_op, h.shiptoaddressid,
            h.orderdate as "OrderDate", h.modifieddate as orderupdatedtm
            from net2 n left join hdr2 h on n.salesorderid = h.salesorderid""",
        "join_changes_detail": """select n.salesorderid, n.sys_change_op,
            d.productid as "ProductID", d.orderqty as productorderqty,
            cast(d.linetotal as double) as productsales
            from net2 n left join det2 d on n.salesorderid = d.salesorderid""",
        "capture_orders": f"select {_CAPTURED} from cap2",
        "capture_all_orders": f"select {_CAPTURED} from cap1",
        "count_by_op": "select sys_change_op, count(*) as row_count from cap2 group by 1",
        "count_by_op_total": """select sys_change_op, count(*) as row_count from cap2
            group by rollup (sys_change_op)""",
        "stringify_wire": f"select {wire} from cap2",
        "parse_wire": f"select {_STAGING} from stg2",
        "parse_wire_variant": f"""select {_STAGING}, case when salesorderid % 5 = 0
            then '{{"colour":"blue"}}' end as more from stg2""",
        "quarantine_rows": """select * from (with line as (select salesorderid, case
              when (salesorderid + coalesce("ProductID", 0)) % 97 = 0 then 'not JSON'
              when (salesorderid + coalesce("ProductID", 0)) % 97 = 1
                and productorderqty is not null then 'unreadable productorderqty' end as problem
              from cap2),
            told as (select salesorderid, coalesce(problem, case when salesorderid in (
              select salesorderid from line where problem is not null)
              then 'another line of the order' end) as problem from line)
            select cast(2 as bigint) as batch, salesorderid, problem, count(*) as line_count
            from told where problem is not null group by salesorderid, problem) q""",
        "quarantine_loaded": f"""select {_STAGING} from stg2 where salesorderid not in (
            select salesorderid from stg2 where (salesorderid + coalesce(productid, 0)) % 97 = 0
              or ((salesorderid + coalesce(productid, 0)) % 97 = 1
                and productorderqty is not null))""",
        "short_batches": """select cast(2 as bigint) as job_exec_id, count(*) as row_count,
            count(*) filter (salesorderid % 2 = 0) as line_count from cap2
            having count(*) <> count(*) filter (salesorderid % 2 = 0)""",
        "quantity_overflows": """select salesorderid, productid, count(*) as line_count from stg1
            group by all having sum(cast(productorderqty as hugeint)) * 144115188075855872
              > 9223372036854775807""",
        "ledger_violations": """select job_exec_id,
            'a job that has ended needs a status' as broken from led
            where job_exec_status is null""",
        "merge_actions": """select b.salesorderid, b.productid, b.orderdate, b.productname,
              b.postalcode, b.productorderqty, b.productsales, b.orderupdatedtm,
              b.src_cdt_batch_id, 'upsert' as action
            from agg3 b join verdict_after1_agg3 v on b.salesorderid = v.salesorderid where v.d = 0
            union all
            select a.salesorderid, a.productid, null, null, null, null, null, b.orderupdatedtm,
              v.batch, case when b.salesorderid is null then 'delete' else 'delete at' end
            from after1 a join verdict_after1_agg3 v on a.salesorderid = v.salesorderid and v.d = 1
            left join agg3 b on a.salesorderid = b.salesorderid and a.productid = b.productid
            union all
            select salesorderid, null, null, null, null, null, null, null, batch, 'tombstone'
            from verdict_after1_agg3 where d = 1 and not known""",
        "copy_to_stage": f"select {_STAGING} from stg2",
        "ready_batch_counts": """select cast(1 as bigint) as job_exec_id, count(*) as row_count
            from cap1 union all select cast(2 as bigint), count(*) from cap2""",
        "stage_preagg": f"select {_STAGING} from agg1",
        "latest_batch_per_order": f"select {_STAGING} from latest",
        "merge_conflicts": """select salesorderid, productid, count(*) as row_count from stgboth
            group by salesorderid, productid having count(*) > 1""",
        "merge_orders_reference": _merge_reference("after1", "agg2"),
        "merge_matched_update": f"""select {_ORDERS.replace(', deleted_flg', '')}
            from ({_merge_matched('after1', 'agg3')}) m""",
        "merge_soft_delete": f"""select salesorderid, productid, src_cdt_batch_id, deleted_flg
            from ({_merge_matched('after1', 'agg3')}) m""",
        "merge_insert_new": f"""{_as_new('agg2')} b where not exists (select 1 from after1 a
            where a.salesorderid = b.salesorderid and a.productid = b.productid)""",
        "merge_orders": merged,
        "merge_orders_with_lines": f"select {_ORDERS} from merged_after1_agg3",
        "merge_ignores_stale": f"select {_ORDERS} from merged_only2_agg1",
        "merge_both_batches": f"select {_ORDERS} from merged_empty_latest",
        "live_orders": f"{merged} where deleted_flg = 0",
        "order_summary": _summary("merged_after1_agg2"),
        "order_summary_table": _summary("after1"),
        "order_summary_first_load": _summary("after1"),
        "load_run": merged,
        "load_run_reference": _merge_reference("after1", "agg2"),
        "load_stream": merged,
        "last_success_version": """select db_chg_version_id from (
            select db_chg_version_id, job_end_ts from led where job_exec_status = 0
            union all select cast(0 as bigint), cast('1980-01-01 00:00:00' as timestamp)) a
            order by job_end_ts desc nulls last, db_chg_version_id desc limit 1""",
        "last_success_version_empty": """select db_chg_version_id from (
            select db_chg_version_id, job_end_ts from led
            where case when job_exec_id < 0 then 0 end = 0
            union all select cast(0 as bigint), cast('1980-01-01 00:00:00' as timestamp)) a
            order by job_end_ts desc nulls last, db_chg_version_id desc limit 1""",
        "ledger_start": f"""select * from led union all
            select (select max(job_exec_id) + 1 from led), cast(null as int),
              (select coalesce(max(ver), 0) from clog), {_NOW}, cast(null as timestamp)""",
        "ledger_end": f"""select job_exec_id, case when ends then 0 else job_exec_status end
              as job_exec_status, db_chg_version_id, job_start_ts,
              case when ends then {_NOW} else job_end_ts end as job_end_ts
            from (select led.*, job_exec_id = (select max(job_exec_id) from led
                    where job_exec_status is null) as ends from led) x""",
        "distinct_persons": "select distinct * from person",
        "distinct_addresses": "select distinct * from paddr",
        "column_domains": domains,
        "key_domains": """
            select 'stateprovince' as domain, cast(n_nationkey as bigint) as id,
              cast(null as bigint) as specialofferid from nation
            union all select 'address', c_custkey, null from customer
            union all select 'customer', c_custkey, null from customer
            union all select distinct 'specialofferproduct', l_partkey, l_suppkey from lineitem""",
        "assign_keys": """select (select max(c_custkey) from customer)
              + row_number() over (order by c_mktsegment, c_name) as businessentityid,
              c_mktsegment, c_name from customer""",
        "assign_order_keys": """select (select max(o_orderkey) from orders)
              + row_number() over (order by o_orderdate, o_orderkey) as salesorderid,
              o_orderdate, o_orderkey from orders""",
        "split_order_headers": """select o_orderkey as salesorderid, o_custkey as customerid,
              o_orderdate as orderdate, o_totalprice as subtotal from orders""",
        "split_order_details": """select l_orderkey as salesorderid, l_partkey as productid,
              l_suppkey as specialofferid, cast(l_quantity as int) as orderqty,
              l_extendedprice as unitprice, l_discount as unitpricediscount from lineitem""",
        "order_terms": """select o_orderkey as salesorderid,
              cast(cast(o_orderdate as date) as timestamp) as orderdate,
              cast(cast(o_orderdate as date) + 15 as timestamp) as duedate,
              cast(cast(o_orderdate as date) + 7 as timestamp) as shipdate,
              o_totalprice as subtotal,
              cast(cast(cast(o_totalprice as decimal(18,4)) * cast('0.07898' as decimal(6,5))
                as decimal(18,4)) as double) as taxamt,
              5 as status, 0 as onlineorderflag, 1 as shipmethodid, 8 as revisionnumber
            from orders""",
        "document_numbers": """select o_orderkey as ponumber, o_custkey % 10000 as branch,
              o_orderkey % 1000000 as serial, printf('PO%08d', o_orderkey) as purchaseordernumber,
              printf('10-%04d-%06d', o_custkey % 10000, o_orderkey % 1000000) as accountnumber
            from orders""",
        "unit_prices": """select l_orderkey as salesorderid, l_partkey as productid,
              cast(round(l_extendedprice * 100) as bigint) as pricecents,
              l_discount as discount,
              cast(round(cast(round(l_extendedprice * 100) as bigint) / 100, 2) as double)
                as unitprice,
              round(l_discount, 2) as unitpricediscount from lineitem""",
    }
    relations = _relations()
    return {name: _with(relations, query) for name, query in sql.items()}
