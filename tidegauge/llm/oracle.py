"""Queries of this package in SQL, where SQL can express them."""

ORACLE = {
    "op2_warc": """
        with p as (
            select page_id, cast(strlen(coalesce(html, '')) as bigint) payload_bytes,
                   sha256(coalesce(html, '')) payload_digest
            from pages),
        f as (select *, min(page_id) over (partition by payload_digest) first from p)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and first is not null and page_id is distinct from first
                    then 'revisit'
                    else 'response' end record_type,
               case when payload_bytes >= 100 and page_id is distinct from first then first end refers_to
        from f""",
    # The rate that the iterations find is the target for the source's size.
    "op7_mixing": r"""
        with d as (
            select doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) size,
                   sha256(coalesce(cast(doc_id as varchar), '')) h
            from documents),
        s as (select source, cast(sum(size) as bigint) source_size from d group by source),
        w as (
            select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)
                ::bigint]::double weight from s),
        l as (
            select *, source_size / weight ratio,
                   (sum(source_size) over () * 1.5::double
                    - coalesce(sum(source_size) over before, 0)::double * 2)
                   / (sum(weight) over () - coalesce(sum(weight) over before, 0)) "level"
            from w window before as (order by source_size / weight, source nulls last
                                     rows between unbounded preceding and 1 preceding)),
        t as (
            select source, source_size, case when "level" * weight > source_size * 2
                then source_size * 2.0::double
                else weight * (select "level" from l where "level" * weight <= source_size * 2
                               order by ratio, "level" limit 1) end target
            from l),
        r as (
            select d.*, t.source_size, t.target,
                   case when t.source_size > 0 then least(2.0, t.target / t.source_size)
                        else 0 end rate,
                   coalesce(sum(size) over (
                       partition by d.source
                       order by ('0x' || h[:4])::bigint % 1024, h, doc_id, size
                       rows between unbounded preceding and 1 preceding), 0) ahead
            from d join t on d.source is not distinct from t.source)
        select doc_id, cast(size as bigint) size, source_size, target,
               cast((floor(rate) + case when ahead + size / 2
                     <= (rate - floor(rate)) * source_size then 1 else 0 end) * size as bigint) taken
        from r""",
}


def oracle_sql():
    return dict(ORACLE)
