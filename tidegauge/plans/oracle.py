"""The registered queries in SQL, for a comparison on the same tables."""

from tidegauge import schemas

_SENSOR = """
    select event_id seq, 'R' || user_id resid, strftime(ts, '%Y-%m-%d') "date",
           strftime(ts, '%H:%M:%S') "time", value hz, cast(props->>'$.k' as double) disp,
           cast(event_id % 100 as double) flo, cast(user_id as double) "sedPPM", value psi,
           cast(hour(ts) as double) "chlPPM", ts
    from events"""
_PUMP = """
    select 'R' || c_custkey resid, c_mktsegment "pumpType", '2015-03-01' "purchaseDate",
           '2016-04-02' "serviceDate", n_name vendor, cast(c_custkey % 180 as float) longitude,
           cast(c_custkey % 90 as float) lattitude
    from customer join nation on c_nationkey = n_nationkey"""
_MAINT = """
    select 'R' || o_custkey resid, strftime(o_orderdate, '%Y-%m-%d') "eventDate",
           o_orderpriority technician, o_orderstatus description
    from orders"""
_EMPLOYEE = """
    select cast(c_custkey as bigint) emp_no, '1960-01-01' birth_date, c_mktsegment first_name,
           c_name last_name, case when c_custkey % 2 = 0 then 'M' else 'F' end gender,
           '1990-01-01' hire_date
    from customer"""
_FIELDS = '"' + '", "'.join(schemas.SENSOR.fieldNames()) + '"'
_ALERT_VIEW = f"""
    select a.resid, a."date", a.psi, p."pumpType", p."purchaseDate", p."serviceDate", p.vendor,
           m."eventDate", m.technician, m.description
    from ({_SENSOR}) a join ({_PUMP}) p on a.resid = p.resid
    join ({_MAINT}) m on p.resid = m.resid
    where a.psi < 5.0"""
_LINE = """'R' || user_id || ',' || strftime(ts, '%Y-%m-%d,%H:%M:%S') || ',' || value || ','
    || cast(props->>'$.k' as double) || ',' || cast(event_id % 100 as double) || ','
    || cast(user_id as double) || ',' || value || ',' || cast(hour(ts) as double)"""


def _vmstat(names):
    return ", ".join(f'cast(event_id * {i} % 1000 as varchar) "{n}"'
                     for i, n in enumerate(names, 1))


def _extremes(metrics):
    return ", ".join(f'max("{m}") "max{m}", min("{m}") "min{m}", round(avg("{m}"), 6) "avg{m}"'
                     for m in metrics)


def _cell(family, column, source, key="""resid || '_' || "date" || ' ' || "time\"""",
          value=None, where="true", extra=""):
    value = value or f'cast("{column}" as varchar)'
    return (f"select {key} row_key, '{family}' family, '{column}' qualifier, "
            f"{value} \"value\"{extra} from {source} where {where}")


def _cells(columns, where="true", alert_where=None, extra="", value=None):
    parts = [_cell("data", c, "s", where=where, extra=extra,
                   value=value and value.format(c)) for c in columns]
    if alert_where:
        parts.append(_cell("alert", "psi", "s", where=alert_where, extra=extra,
                           value=value and value.format("psi")))
    return f"with s as ({_SENSOR}) " + " union all ".join(parts)


def _last(select, keys, order):
    return (f"select * exclude (_n) from (select *, row_number() over "
            f"(partition by {keys} order by {order}) _n from ({select})) where _n = 1")


_TEXT_COLUMNS = ["resid", "date"] + schemas.METRICS
_HALF = ', ("chlPPM" >= 12) half, seq'
_DECODED = f"""
    select resid || '_' || "date" || ' ' || "time" "key", resid "resID", "date",
           {', '.join('"' + m + '"' for m in schemas.METRICS)}
    from ({_last(_SENSOR, 'resid, "date", "time"', 'seq desc')})"""
_WINDOWS = f"""
    select timestamp '1970-01-01' + interval (x) second w_start, s.*
    from (select *, unnest([(floor(epoch(ts) / 7200) * 7200 - k * 7200)::bigint
                            for k in [0, 1, 2]]) x from ({_SENSOR})) s"""
_VMSTAT_LAST = _last(f"select {_vmstat(schemas.VMSTAT.fieldNames())}, event_id seq from events",
                     '"CACH"', "seq desc")
_VMSTAT_CELLS = " union all ".join(
    _cell("data", n, "events", key="strftime(ts, '%Y-%m-%d %H:%M:%S')",
          value=f"cast(event_id * {i} % 1000 as varchar)", extra=", event_id seq")
    for i, n in enumerate(schemas.VMSTAT_COUNTERS, 1))


def _keyword(terms):
    outside = r"[^\p{L}\p{M}\p{N}_]"
    words = "|".join(terms)
    return f"regexp_matches(text, '(?i)(^|{outside})({words})($|{outside})')"


def _binary_cells():
    """Cells whose value is the hex of the double's bytes, put together from its exponent
    and fraction. log2 may miss by one next to a power of two, hence the correction."""
    cells = _cells(schemas.METRICS, alert_where="psi < 5.0", value='"{}"')
    return f"""
        with c as ({cells}),
        g as (select *, cast(floor(log2(nullif("value", 0))) as int) g from c),
        e as (select *, case when pow(2.0, g) > "value" then g - 1
                             when pow(2.0, g + 1) <= "value" then g + 1 else g end e from g)
        select row_key, family, qualifier,
               printf('%016X', case when "value" = 0 then 0 else
                   cast(e + 1023 as bigint) * 4503599627370496
                   + cast(("value" / pow(2.0, e) - 1) * 4503599627370496 as bigint) end) "value"
        from e"""


ORACLE = {
    "parse_sensor_lines": f"select {_FIELDS} from ({_SENSOR})",
    "parse_pump_lines": _PUMP,
    "parse_maint_lines": _MAINT,
    "employees_csv_strip": _EMPLOYEE,
    "employees_csv_keep": _EMPLOYEE,
    "employees_json": _EMPLOYEE,
    "employees_xml": _EMPLOYEE,
    "employees_avro": _EMPLOYEE,
    "vmstat_strict": f"select {_vmstat(schemas.VMSTAT.fieldNames())} from events",
    "vmstat_lenient": f"""
        select {_vmstat(schemas.VMSTAT_COUNTERS)}, strftime(ts, '%Y-%m-%d') "DATE",
               strftime(ts, '%H:%M:%S') "TIME" from events""",
    "low_pressure_alerts": f"select {_FIELDS} from ({_SENSOR}) where psi < 5.0",
    "keyword_posts": f"""
        select cast(doc_id as bigint) id, text, source created_at
        from documents where {_keyword(["thing", "water"])}""",
    "sensor_stats6": f"""
        select resid, "date", {_extremes(schemas.METRICS)}
        from ({_SENSOR}) group by resid, "date\"""",
    "sensor_counts": f"""
        select resid, "date", count(resid) total from ({_SENSOR}) group by resid, "date\"""",
    "psi_stats": f"""
        select resid, "date", {_extremes(["psi"])} from ({_SENSOR}) group by resid, "date\"""",
    "window_counts": f"""
        select w_start, resid, "date", count(resid) total
        from ({_WINDOWS}) group by w_start, resid, "date\"""",
    "window_psi": f"""
        select w_start, resid, "date", {_extremes(["psi"])}
        from ({_WINDOWS}) group by w_start, resid, "date\"""",
    "alert_maintenance": _ALERT_VIEW,
    "alert_maintenance_spread": _ALERT_VIEW,
    "cells_text": _cells(_TEXT_COLUMNS),
    "cells_alert": f"with s as ({_SENSOR}) " + _cell("alert", "psi", "s", where="psi < 5.0"),
    "cells_route_both": _cells(_TEXT_COLUMNS, alert_where="psi < 5.0"),
    "cells_route_exclusive": _cells(schemas.METRICS, "psi >= 5.0", "psi < 5.0"),
    "cells_decode": _DECODED,
    "cells_project_family": f"""
        select cast("chlPPM" as varchar) "chlPPM", cast(flo as varchar) flo
        from ({_last(_SENSOR, 'resid, "date", "time"', 'seq desc')})""",
    "cells_binary": _binary_cells(),
    "cells_binary_roundtrip": f"""
        select "key", '' "resID", '' "date", {', '.join('"' + m + '"' for m in schemas.METRICS)}
        from ({_DECODED})""",
    "cells_vmstat": f"select row_key, family, qualifier, \"value\" from ({_VMSTAT_CELLS})",
    "cells_employee": f"with e as ({_EMPLOYEE}) " + " union all ".join(
        _cell("data", c, "e", key="cast(emp_no as varchar)")
        for c in schemas.EMPLOYEE.fieldNames()),
    "upsert_latest": f"""
        select {_FIELDS}
        from ({_last(_SENSOR, "resid", '("chlPPM" >= 12) desc, seq desc')})""",
    "upsert_vmstat_by_cach": f"select * exclude (seq) from ({_VMSTAT_LAST})",
    "upsert_employees": _EMPLOYEE,
    "upsert_subset_columns": f"""
        with e as ({_EMPLOYEE}),
        b as (
            select c_custkey emp_no, n_name from customer
            join nation on c_nationkey = n_nationkey where c_mktsegment = 'BUILDING'
            union all
            select -s_suppkey, n_name from supplier
            join nation on s_nationkey = n_nationkey)
        select cast(coalesce(b.emp_no, e.emp_no) as bigint) emp_no,
               case when b.emp_no is null then birth_date else '1970-01-01' end birth_date,
               case when b.emp_no is null then first_name else n_name end first_name,
               last_name, case when b.emp_no is null then gender else 'X' end gender,
               case when b.emp_no is null then hire_date else '2000-01-01' end hire_date
        from e full join b on e.emp_no = b.emp_no""",
    "upsert_cells": "select row_key, family, qualifier, \"value\" from ("
        + _last(_cells(_TEXT_COLUMNS, alert_where="psi < 5.0", extra=_HALF),
                "row_key, family, qualifier", "half desc, seq desc") + ")",
    "upsert_posts": f"""
        select cast(doc_id as bigint) tweet_id, text tweet, source created_at
        from documents where {_keyword(["the", "de"])}""",
    "table_head": f"select * from ({_EMPLOYEE}) order by emp_no limit 5",
    "publish_sensor_lines": f"select {_LINE} \"value\" from events",
    "stream_vmstat": f"select * exclude (seq) from ({_VMSTAT_LAST})",
    "stream_vmstat_cells": "select row_key, family, qualifier, \"value\" from ("
        + _last(_VMSTAT_CELLS, "row_key, family, qualifier", "seq desc") + ")",
}
ORACLE.update({
    "stream_batch_stats": f"""
        select resid, "date", cast(floor("chlPPM" / 8) as bigint) batch_id,
               {_extremes(schemas.METRICS)}
        from ({_SENSOR}) group by all""",
    "stream_posts": ORACLE["keyword_posts"].replace(
        "id, text, source", "tweet_id, text tweet, source", 1),
    "stream_report": _ALERT_VIEW,
    "employees_drifting": f"""
        select *, case when emp_no % 3 = 0 then cast(emp_no % 10 as varchar) end "level"
        from ({_EMPLOYEE}) where emp_no % 7 <> 0 and emp_no % 11 <> 0""",
    "employees_drifting_bad": f"""
        with l as (
            select emp_no, '{{"emp_no": ' || case when emp_no % 7 = 0
                then '"no ' || emp_no || '"' else cast(emp_no as varchar) end
                || ', "birth_date": "' || birth_date || '", "first_name": "' || first_name
                || '", "last_name": "' || last_name || '", "gender": "' || gender
                || '", "hire_date": "' || hire_date || '"'
                || case when emp_no % 3 = 0 then ', "level": ' || emp_no % 10 else '' end
                || '}}' line
            from ({_EMPLOYEE}))
        select case when emp_no % 11 = 0 then substr(line, 1, 30) else line end _bad
        from l where emp_no % 7 = 0 or emp_no % 11 = 0""",
    "counted_lines": """
        select 'vmstat' parser, count(*) + 3 * count(*) filter (event_id % 100 = 0) "read",
               count(*) kept, cast(0 as bigint) bad,
               3 * count(*) filter (event_id % 100 = 0) dropped from events
        union all
        select 'sensor', count(*), count(*) filter (hour(ts) <> 0),
               count(*) filter (hour(ts) = 0), 0 from events""",
    "stream_once": ORACLE["sensor_counts"],
    "cells_decode_clustered": _DECODED,
    "cells_scan_prefix": f"""
        select * from ({ORACLE["cells_route_both"]}) where row_key like 'R12%'""",
    "cells_scan_between": f"""
        select arg_max(cast(psi as varchar), seq) psi from ({_SENSOR})
        where psi < 5.0 and resid >= 'R2' and resid < 'R3' group by resid, "date", "time\"""",
    "keyword_posts_many": ORACLE["keyword_posts"],
    "stream_alert_devices": _ALERT_VIEW,
    "alert_maintenance_devices": _ALERT_VIEW,
    "upsert_employee_cells": ORACLE["cells_employee"],
    "permissive_good": f"select {_FIELDS} from ({_SENSOR}) where \"chlPPM\" >= 1",
    "permissive_bad": f"""
        select regexp_replace({_LINE}, ',[^,]*$', '') _bad from events where hour(ts) = 0""",
    "stream_alerts": ORACLE["low_pressure_alerts"],
    "stream_alert_maintenance": _ALERT_VIEW,
    "stream_cells": ORACLE["upsert_cells"],
    "stream_cells_read_back": ORACLE["cells_binary_roundtrip"],
    "stream_window_counts": ORACLE["window_counts"],
})


def oracle_sql():
    return dict(ORACLE)
