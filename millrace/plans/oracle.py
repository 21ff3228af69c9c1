"""DuckDB twins of the named queries."""

_BRANDS = ", ".join(f"'Brand#{i}'" for i in range(11, 26))

_VERSIONS = """
    old as (select s_nationkey as k, s_name as name, cast(cast(s_acctbal as decimal(12,2)) as varchar) as bal from supplier),
    new as (select k, name, case when name like '%3' then bal || ' (usd)' when name like '%4' then '0.01' else bal end as bal from old where name not like '%7')"""

# numbers are equal, so the category is format for a unit on one side and conflict for another amount
_DIFFS = """
    diffs as (
        select coalesce(o.k, n.k) as k, coalesce(o.name, n.name) as name,
            case when n.name is null then '*' else 'bal' end as "column", case when n.name is not null then o.bal end as old, n.bal as new,
            case when n.name is null then 'dropped' when o.bal || ' (usd)' = n.bal then 'format' else 'conflict' end as category
        from old o full join new n on o.name = n.name where n.name is null or o.bal <> n.bal)"""

_FINDINGS = """
    f as (
        select 'L1' as rule_id, 'ERROR' as severity, 'lineitem' as table_name, cast(l_orderkey as varchar) as row_key, 'l_discount' as column_name from lineitem where l_discount > 0.09
        union all select 'L2', 'WARN', 'lineitem', cast(l_orderkey as varchar), 'l_tax' from lineitem where l_tax = 0 and l_returnflag = 'R'
        union all select 'L3', 'INFO', 'lineitem', cast(l_orderkey as varchar), 'l_quantity' from lineitem where l_quantity >= 50
        union all select 'L4', 'WARN', 'lineitem', cast(l_orderkey as varchar), 'l_returnflag' from lineitem where l_returnflag = 'N' and l_linestatus = 'F'
        union all select 'O1', 'WARN', 'orders', cast(o_orderkey as varchar), 'o_totalprice' from orders where o_totalprice < 1000
        union all select 'O2', 'INFO', 'orders', cast(o_orderkey as varchar), 'o_orderpriority' from orders where o_orderpriority like '1%'
        union all select 'O3', 'HALT', 'orders', cast(o_orderkey as varchar), 'o_custkey' from orders where o_custkey is null
        union all select 'O4', 'ERROR', 'orders', cast(o_orderkey as varchar), 'o_orderkey' from orders where o_orderkey not in (select l_orderkey from lineitem))"""

_REFS = """
    refs as (
        select 'stg_pump_config' as table_name, config_id as row_id, organization_id as o, well_id as w, loaded_at as ts from stg_pump_config
        union all select 'esp_well_design_context', context_id, organization_id, well_id, loaded_at from esp_well_design_context
        union all select 'stg_curve_observations', obs_id, organization_id, well_id, loaded_at from stg_curve_observations),
    listed as (select organization_id as o, well_id as w, min(listed_at) as first from well_list group by all),
    alive as (select distinct r.table_name, r.row_id from refs r join well_list l on l.organization_id = r.o and l.well_id = r.w and l.listed_at <= r.ts and (l.removed_at is null or r.ts < l.removed_at)),
    orphan as (
        select r.table_name, strftime(r.ts, '%Y-%m') as period, r.row_id, case when l.first is null then 'missing' when l.first > r.ts then 'late' else 'deleted' end as orphan_kind
        from refs r left join listed l using (o, w) left join alive a on a.table_name = r.table_name and a.row_id = r.row_id
        where r.o is not null and r.w is not null and a.row_id is null)"""

_DAY = """
    case when regexp_matches(trim(effective_from), '^\\d{4}-\\d{1,2}-\\d{1,2}([ T].*)?$') then try_cast(regexp_extract(trim(effective_from), '^(\\d{4}-\\d{1,2}-\\d{1,2})', 1) as date)
         else try_cast(try_strptime(trim(effective_from), '%d-%b-%Y') as date) end"""

_ATTRS = "intake_set_depth_md_ft, motor_type, motor_nameplate_hp, oil_api_deg, water_cut_design_frac, design_frequency_hz"

_CHAINS = f"""
    days as (
        select organization_id, well_id, day, arg_max({{'a': intake_set_depth_md_ft, 'b': motor_type, 'c': motor_nameplate_hp, 'd': oil_api_deg, 'e': water_cut_design_frac, 'f': design_frequency_hz}}, {{'at': loaded_at, 'id': context_id}}) as s
        from (select *, {_DAY} as day from esp_well_design_context) where organization_id is not null and well_id is not null and day is not null group by all),
    marked as (select *, lag(s) over w as before, row_number() over w as rn from days window w as (partition by organization_id, well_id order by day)),
    versions as (select organization_id, well_id, s, day from marked where rn = 1 or s is distinct from before),
    chains as (select organization_id, well_id, s, strftime(day, '%Y-%m-%d') as valid_from, coalesce(strftime(lead(day) over (partition by organization_id, well_id order by day), '%Y-%m-%d'), '9999-12-31') as valid_to from versions)"""


def _number_list(x: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({x}, '[-+]?[\\d,]*\\.?\\d+'), lambda n: try_cast(replace(n, ',', '') as double)))"


def _unit_words(x: str) -> str:
    return f"lower(trim(regexp_replace(regexp_replace({x}, '[-+]?[\\d,]*\\.?\\d+|[()\\[\\]]', ' ', 'g'), '\\s+', ' ', 'g')))"


def _field_category(f: str, numeric: bool, values: bool = False) -> str:
    a, b = f"r.{f}", f"p.{f}"
    form = f"when len({_number_list(a)}) > 0 and list_sort({_number_list(a)}) = list_sort({_number_list(b)}) and ({_unit_words(a)} = {_unit_words(b)} or {_unit_words(a)} = '' or {_unit_words(b)} = '') then 'format'" if numeric else ""
    return f"select r.source_document, r.scenario_ordinal, r.section_order, '{f}' as field_name, case when {a} is null then 'added' when {b} is null then 'dropped' {form} else 'conflict' end as category{f', {a} as old, {b} as new' if values else ''} from r join p on {_SAME} where {a} is distinct from {b}"


_SAME = "r.source_document is not distinct from p.source_document and r.scenario_ordinal is not distinct from p.scenario_ordinal and r.section_order is not distinct from p.section_order"
_FIELDS = ["section_role", "pump_model_as_printed", "manufacturer", "stages", "housing_count", "stages_per_housing_as_printed", "top_md_ft", "bottom_md_ft", "extraction_status"]
_NUMERIC = {"stages", "housing_count", "top_md_ft", "bottom_md_ft"}
_SIDES = f"""
    r as (select distinct source_document, scenario_ordinal, section_order, {", ".join(_FIELDS)} from stg_pump_config),
    p as (select distinct source_document, scenario_ordinal, section_order, {", ".join(_FIELDS)} from stg_pump_config_copy)"""
_DIFF = f"""
    with {_SIDES}
    select r.source_document, r.scenario_ordinal, r.section_order, '*' as field_name, 'only_ref' as category from r where not exists (select 1 from p where {_SAME})
    union all select p.source_document, p.scenario_ordinal, p.section_order, '*', 'only_port' from p where not exists (select 1 from r where {_SAME})
    union all {" union all ".join(_field_category(f, f in _NUMERIC) for f in _FIELDS)}"""

# The unit tokens of each dimension, written down here once more so that the twins do not depend on the engine's table.
_VOCABULARY = {
    "length": "ft ' feet (ft)", "pressure": "psi psia psig (psi)", "power": "kw hp bhp", "frequency": "hz (hz)", "voltage": "v volts", "temperature": "f f° °f ºf (f) degf", "none": "° º",
    "api": "api ºapi °api", "sg": "spgr sg", "density": "lb/ft3 lb/ft³ lbm/ft3", "ratio": "% (0-1) frac", "speed": "rpm", "flow": "bpd bbl/d stb/d stb/day b/d bbl/day",
    "gradient": "psi/ft", "gor": "scf/stb scf/bbl scf/bl", "gas_rate": "mcf/d mscf/d scf/d bpd_gas",
}
_UNITS = ", ".join("('{}', '{}')".format(u.replace("'", "''"), dim) for dim, units in _VOCABULARY.items() for u in units.split())

CELLS = f"""
    unit_names(unit, ud) as (values {_UNITS}),
    c as (unpivot (select config_id, stages, housing_count, top_md_ft, bottom_md_ft, is_design_scenario from stg_pump_config) on stages, housing_count, top_md_ft, bottom_md_ft, is_design_scenario into name "column" value raw),
    t as (select *, trim(raw) as t, "column" = 'is_design_scenario' as is_bool, "column" in ('stages', 'housing_count') as is_int, case when "column" like '%_ft' then 'length' end as dim from c),
    n as (select *, regexp_matches(t, '^[-+]?[\\d,.]+\\s*(-|–|to)\\s*[\\d,.]+') as rng, try_cast(replace(regexp_extract(t, '^([-+]?[\\d,]*\\.?\\d+)\\s*(.*)$', 1), ',', '') as double) as v, trim(regexp_extract(t, '^([-+]?[\\d,]*\\.?\\d+)\\s*(.*)$', 2)) as rest from t),
    b as (select *, trim(regexp_replace(rest, '\\([^)]*\\)', '', 'g')) as bare from n),
    u as (select *, case when rng then '' else lower(trim(case when bare <> '' then bare else rest end, '.,; ')) end as unit from b),
    w as (select u.*, unit_names.ud from u left join unit_names using (unit)),
    y as (select *, case when t = '' then 'empty_string' when is_bool then case when lower(t) not in ('true', 'yes', 'y', 'false', 'no', 'n') then 'not_boolean' end when rng then 'range_not_scalar' when v is null then 'not_numeric'
        when ud is null and regexp_matches(unit, '\\d') then 'composite_value' when unit <> '' and ud is null then 'unrecognized_unit_token' when unit <> '' and ud <> 'none' and dim is not null and ud <> dim then 'unit_dimension_mismatch' end as why from w),
    cells as (select config_id, "column", raw, case when why is not null and why <> 'unrecognized_unit_token' then null when is_bool then case when lower(t) in ('true', 'yes', 'y') then 1.0 else 0.0 end when is_int and abs(v - round(v)) > 1e-9 then null else v end::double as value,
        case when not is_bool and unit <> '' then unit end as unit, coalesce(why, case when is_int and abs(v - round(v)) > 1e-9 then 'non_integer_in_integer_column' end) as reason from y)"""

ORACLE = {
    "w1_latest_per_key": """
        select * exclude (rn) from (
            select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders
        ) where rn = 1""",
    "w2_argmax_events": """
        select user_id, event_type, event_id, value from (
            select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1""",
    "w4_consecutive_dedupe": """
        select event_id, user_id, event_type from (
            select *, lag(event_type) over w as p, row_number() over w as rn from events window w as (partition by user_id order by ts, event_id)
        ) where rn = 1 or event_type is distinct from p""",
    "w5_monotonic": """
        select l_orderkey, count(p) as n, sum(case when l_extendedprice < p then 1 else 0 end)::bigint as n_back from (
            select *, lag(l_extendedprice) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as p from lineitem where l_extendedprice is not null
        ) group by l_orderkey""",
    "w6_carry_forward": """
        select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (
            partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as carried from events""",
    "w7_dense_renumber": """
        select l_orderkey, l_linenumber, case when l_returnflag <> 'R' then (sum(case when l_returnflag <> 'R' then 1 else 0 end) over (
            partition by l_orderkey order by l_linenumber))::int end as new_no from lineitem""",
    "w9_newest_done": """
        select o_orderkey, o_orderstatus = 'F' and row_number() over (partition by o_custkey, o_orderstatus order by o_orderdate desc, o_orderkey desc) = 1 as newest_done from orders""",
    "w10_topk": """
        select p_brand, p_partkey, p_retailprice, rank::int as rank from (
            select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as rank from part) where rank <= 5""",
    "w11_chosen_variant": """
        select source_document, arg_min(scenario_ordinal, {'r': case when is_design_scenario = 'true' then 0 else 1 end, 'l': length(scenario_ordinal), 'v': scenario_ordinal}) as chosen
        from stg_pump_config where source_document is not null and scenario_ordinal is not null group by source_document""",
    "v08_contiguous": """
        select l_orderkey, min(l_linenumber) = 1 and max(l_linenumber) = count(*) and count(distinct l_linenumber) = count(*) as contiguous from lineitem group by l_orderkey""",
    "a1_group_rollup": """
        with s as (select l_orderkey, case when l_suppkey % 3 <> 0 then 'M' || (l_suppkey % 5) end as model, 'part ' || l_partkey as printed, l_linenumber as ord, l_quantity::int as stages,
                l_extendedprice as top, l_extendedprice + l_quantity as bottom, case l_returnflag when 'R' then 'conflict' when 'A' then 'validated' else 'extracted' end as status from lineitem)
        select l_orderkey, coalesce(model, 'printed: ' || printed) as model_key, nullif(sum(stages), 0)::bigint as stages, count(*) as housings, min(top) as top, max(bottom) as bottom,
            arg_min(printed, {'o': ord, 'p': printed}) as first_printed, min(ord) as first_order, string_agg(stages::varchar, ', ' order by ord, printed, stages::varchar) as stages_list,
            case when bool_or(status = 'conflict') then 'conflict' when bool_and(status = 'validated') then 'validated' else 'extracted' end as status
        from s group by l_orderkey, coalesce(model, 'printed: ' || printed)""",
    "a2_variance": """
        with long as (unpivot (select source_document, scenario_ordinal, section_order, config_id, manufacturer, vendor_family, stages, top_md_ft from stg_pump_config
                where source_document is not null and scenario_ordinal is not null) on manufacturer, vendor_family, stages, top_md_ft into name "column" value v),
        first as (select source_document, "column", scenario_ordinal, arg_min(trim(v, ' '), {'s': coalesce(section_order, ''), 'c': config_id}) as value from long where trim(v, ' ') <> '' group by all)
        select source_document, "column", count(distinct value) as n_values, case "column" when 'manufacturer' then 'A' when 'stages' then 'B' else 'C' end as tier
        from first group by source_document, "column" having count(distinct value) > 1""",
    "a4_set_identity": """
        with s as (select o_custkey, year(o_orderdate) as y, string_agg(o_orderpriority || '|' || o_orderstatus, ';' order by o_orderpriority, o_orderstatus) as members from orders group by all)
        select o_custkey, count(*) as n_variants, count(distinct members) as n_sets, count(distinct members) = 1 as same from s group by o_custkey""",
    "a5_grouping_sets": "select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity::decimal(18,2))::double as qty from lineitem group by grouping sets ((l_returnflag, l_linestatus), (l_returnflag), ())",
    "a5_rollup": "select o_orderpriority, o_orderstatus, count(*) as n, min(o_orderdate) as first_date from orders group by rollup (o_orderpriority, o_orderstatus)",
    "a12_agreement": """
        select rater, round(count_if((length(text) > 800) = (reading_level >= 3)) / nullif(count(text), 0)::double, 6) as agreement, count(*) as n
        from reading_labels join documents using (doc_id) where reading_level is not null group by rater""",
    "a13_percent_delta": """
        with o as (select o_custkey, count_if(month(o_orderdate) <= 6) as a, count_if(month(o_orderdate) > 6) as b from orders group by o_custkey)
        select o_custkey, a::bigint as a, b::bigint as b, case when a > 0 then round((b - a) * 100.0 / a, 2)::double end as delta from o""",
    "a16_fingerprint": "select sha256(text) as fingerprint, count(*) as n, count(distinct source) as n_parents, min(doc_id) as first_key from documents where text is not null group by 1 having count(*) > 1",
    "typing_parse_scalar": f"with {CELLS} select * from cells",
    "typing_quarantine": f"""with {CELLS} select "column", reason, count(*) as n, min(raw) as least from cells where reason is not null group by all""",
    "typing_observations": f"""
        with unit_names(unit, ud) as (values {_UNITS}),
        c as (unpivot (select obs_id, head_as_printed, power_as_printed, frequency_hz_as_printed, stages_at_observation, free_gas_at_inlet_pct from stg_curve_observations)
            on head_as_printed, power_as_printed, frequency_hz_as_printed, stages_at_observation, free_gas_at_inlet_pct into name "column" value raw),
        dims(name, dim) as (values ('head_as_printed', 'length'), ('power_as_printed', 'power'), ('frequency_hz_as_printed', 'frequency'), ('stages_at_observation', null), ('free_gas_at_inlet_pct', 'ratio')),
        t as (select *, regexp_replace(raw, '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g') as t from c join dims on name = "column"),
        n as (select *, regexp_matches(t, '^[-+]?[\\d,.]+\\s*(-|–|to)\\s*[\\d,.]+') as rng, try_cast(replace(regexp_extract(t, '^([-+]?[\\d,]*\\.?\\d+)\\s*(.*)$', 1), ',', '') as double) as v, trim(regexp_extract(t, '^([-+]?[\\d,]*\\.?\\d+)\\s*(.*)$', 2)) as rest from t),
        b as (select *, trim(regexp_replace(rest, '\\([^)]*\\)', '', 'g')) as bare from n),
        u as (select *, case when rng then '' else lower(regexp_replace(trim(case when bare <> '' then bare else rest end), '^[.,;]+|[.,;]+$', '', 'g')) end as unit from b),
        w as (select u.*, unit_names.ud from u left join unit_names using (unit)),
        y as (select *, case when t = '' then 'empty_string' when rng then 'range_not_scalar' when v is null then 'not_numeric' when ud is null and regexp_matches(unit, '\\d') then 'composite_value' when unit <> '' and ud is null then 'unrecognized_unit_token'
            when unit <> '' and ud <> 'none' and dim is not null and ud <> dim then 'unit_dimension_mismatch' end as why from w),
        z as (select "column", coalesce(why, case when "column" = 'stages_at_observation' and abs(v - round(v)) > 1e-9 then 'non_integer_in_integer_column' end) as reason, case when why is not null and why <> 'unrecognized_unit_token' then null when "column" = 'stages_at_observation' and abs(v - round(v)) > 1e-9 then null
            when unit = '(0-1)' and dim = 'ratio' then v * 100 else v end as value from y)
        select "column", reason, count(*) as n, round(sum(value), 2) as total from z group by all""",
    "typing_props": """
        select key, count(*) as n, sum(try_cast(v as bigint))::bigint as total from (
            select unnest(json_keys(props)) as key, json_extract_string(props, unnest(json_keys(props))) as v from events) where key not in ('ref', 'source') group by key""",
    "expr_affinity": """
        with l as (select *, case when l_linenumber = 7 then null else l_linenumber * 10.0::double end as f from lineitem)
        select l_orderkey, l_linenumber, round(l_quantity * pow(60 / f, 1), 6) as flow60,
            round(case when l_returnflag = 'R' then l_extendedprice * pow(60 / f, 2) else l_extendedprice * pow(60 / f, 2) / nullif(l_linenumber - 1, 0) end, 6) as head60,
            round(l_quantity * pow(60 / f, 3), 6) as power60 from l""",
    "expr_psia": """
        select context_id, round(case when lower(trim(bubble_point_unit_as_printed)) = 'psig' then try_cast(bubble_point_psi as double) + 14.7 else try_cast(bubble_point_psi as double) end, 6) as value,
            case when lower(trim(bubble_point_unit_as_printed)) = 'psi' then 'bare_psi' when coalesce(trim(bubble_point_unit_as_printed), '') = '' then 'no_unit' end as reason from esp_well_design_context""",
    "expr_gravity": """
        select context_id, round_even(141.5 / (131.5 + oil_api_deg), 4) as sg,
            round(0.433 * (round_even(141.5 / (131.5 + oil_api_deg), 4) * (1 - water_cut_design_frac) + 1.02 * water_cut_design_frac), 4) as gradient from esp_well_design_context""",
    "expr_surrogate": """
        select 'obs_' || substr(sha1(l_orderkey || '|' || l_linenumber || '|' || case when l_returnflag <> 'N' then l_returnflag else '' end), 1, 16) as id, l_orderkey, l_linenumber from lineitem""",
    "expr_run_id": """
        select event_id, strftime(ts, '%Y%m%dT%H%M%S') || '-' || substr(sha256('in/' || user_id || '.pdf@' || event_type), 1, 8) as run_id from events""",
    "e1_alias_precedence": f"""
        select distinct p_brand as family, p_name as printed,
            case when lower(trim(p_name)) = 'part 3' then null when p_brand = 'Brand#11' and lower(trim(p_name)) = 'part 1' then 'P1B' when p_brand = 'Brand#12' and lower(trim(p_name)) = 'part 2' then null
                 when p_brand in ({_BRANDS}) and regexp_full_match(p_name, 'Part \\d+') then upper(replace(p_name, ' ', '')) end as canonical,
            case when lower(trim(p_name)) = 'part 3' then 'evidence' when p_brand = 'Brand#11' and lower(trim(p_name)) = 'part 1' then 'sheet' when p_brand = 'Brand#12' and lower(trim(p_name)) = 'part 2' then 'sheet'
                 when p_brand in ({_BRANDS}) and regexp_full_match(p_name, 'Part \\d+') then 'grammar' end as basis,
            case when lower(trim(p_name)) = 'part 3' then 'not_a_model' when p_brand = 'Brand#11' and lower(trim(p_name)) = 'part 1' then 'seed' when p_brand = 'Brand#12' and lower(trim(p_name)) = 'part 2' then 'composite'
                 when p_brand in ({_BRANDS}) and regexp_full_match(p_name, 'Part \\d+') then 'clean' else 'unresolved' end as flag
        from part""",
    "e5_family_free": "select lower(trim(pump_model_canonical)) as printed_key, min(pump_model_canonical) as canonical, min(curve_basis) as basis from pump_catalogue group by 1 having count(distinct pump_model_canonical) = 1",
    "e6_catalogue": """
        with n as (select distinct pump_model_as_printed as printed from stg_pump_config where pump_model_as_printed is not null),
        c as (select distinct pump_model_canonical as m from pump_catalogue where pump_model_canonical is not null),
        ke as (select m, regexp_replace(lower(m), '[^\\pL\\pN]', '', 'g') as key, lower(trim(m)) as ck from c),
        a as (select printed, (select list_sort(list(m)) from ke where m = printed) as e, (select list_sort(list(m)) from ke where ck = lower(trim(printed))) as s,
                (select list_sort(list(m)) from ke where key = nullif(regexp_replace(lower(printed), '[^\\pL\\pN]', '', 'g'), '')) as k from n),
        h as (select *, coalesce(e, s, k) as hits from a)
        select printed, case when trim(printed) = '' or hits is null then 'none' when len(hits) > 1 then 'ambiguous' when e is not null then 'exact' when s is not null then 'case' else 'key' end as how,
            case when trim(printed) <> '' and len(hits) = 1 then hits[1] end as match, case when trim(printed) <> '' and len(hits) > 1 then array_to_string(hits, '|') end as candidates from h""",
    "e12_near_names": """
        with f as (select distinct lower(trim(regexp_replace(regexp_replace(pump_model_as_printed, '[\u200b-\u200d\u2060\ufeff\u00ad]', '', 'g'), '[\\s\\pZ]+', ' ', 'g'))) as form, pump_model_as_printed as n from stg_pump_config where pump_model_as_printed is not null)
        select form, count(*) as n_names, string_agg(n, '|' order by n) as names from f group by form having count(*) > 1""",
    "j2_fill_or_conflict": """
        with j as (select o_orderkey, case when o_orderkey % 3 <> 0 then o_totalprice end as own, round(l_extendedprice, 0) as offered, l_linenumber as ord from orders join lineitem on o_orderkey = l_orderkey where l_extendedprice is not null),
        e as (select *, coalesce(own, first_value(offered) over w) as effective, row_number() over w as rn from j window w as (partition by o_orderkey order by ord, offered))
        select o_orderkey, ord, offered, effective, case when own is null and rn = 1 then 'filled' when abs(offered - effective) <= 1e-6 then 'duplicate' else 'disagreement' end as disposition from e""",
    "j3_positional_outer": f"""
        with {_VERSIONS}, a as (select *, row_number() over (partition by k order by '{{"bal":"' || bal || '","name":"' || name || '"}}')::int as position from old),
        b as (select *, row_number() over (partition by k order by '{{"bal":"' || bal || '","name":"' || name || '"}}')::int as position from new)
        select coalesce(a.k, b.k) as k, coalesce(a.position, b.position) as position, a.name as old_name, b.name as new_name from a full join b on a.k = b.k and a.position = b.position""",
    "d3_field_diff": f"""with {_VERSIONS}, {_DIFFS} select name, 1::int as position, "column", old, new, category from diffs""",
    "d5_verdict": f"""
        with {_VERSIONS}, {_DIFFS}
        select k, count_if(category = 'added')::bigint as added, count_if(category = 'dropped')::bigint as dropped, count_if(category = 'format')::bigint as format, count_if(category = 'conflict')::bigint as conflict,
            count_if(category in ('conflict', 'dropped')) = 0 as passed from diffs group by rollup (k)""",
    "d1_align": """
        with r as (select config_id, source_document as s, case when config_id % 2 = 0 then scenario_ordinal end as o, section_role as l from stg_pump_config),
        bl as (select s, l, min(o) as v from r where o is not null and l is not null group by s, l having count(distinct o) = 1),
        so as (select s, min(o) as v from r where o is not null group by s having count(distinct o) = 1)
        select config_id, coalesce(r.o, bl.v, so.v, 'unaligned: ' || coalesce(r.l, '')) as variant from r left join bl using (s, l) left join so on so.s = r.s""",
    "d7_recheck": f"""
        with {_VERSIONS}, sheet as (select o.name, o.bal as old, n.bal as new from old o join new n using (name)),
        now as (select name, case when name like '%4' then '0.01' else bal end as bal from old where name not like '%5')
        select case when c.bal is null then 'absent' when c.bal = s.old then 'matches_old' when c.bal = s.new then 'matches_new' else 'other' end as status, count(*) as n from sheet s left join now c using (name) group by 1""",
    "j6_semi": "select c_custkey, c_nationkey from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')",
    "j7_anti": "select c_custkey, c_nationkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null and o_orderpriority like '1%' and o_totalprice > 300000)",
    "j8_grounding": """
        with c as (select page_id, report_id, page_no, trim(regexp_replace(page_text, '[\\s\\pZ]+', ' ', 'g')) as t, regexp_extract(page_text, 'checksum (\\d+)', 1) as v from page_texts where page_text is not null),
        x as (select a.page_id as value_id, a.v, b.page_no as p, b.page_no = a.page_no - a.page_no % 2 as cited,
                a.v <> '' and regexp_matches(b.t, '(^|[^\\d.,])' || a.v || '($|[^\\d.,]|[.,]($|\\D))') as hit from c a join c b using (report_id))
        select value_id::varchar as value_id, case when any_value(v) = '' then 'not_evaluated' when bool_or(hit and cited) then 'cited_page' when bool_or(hit) then 'other_page' else 'not_found' end as grounding,
            case when bool_or(hit and cited) then coalesce(string_agg(distinct case when hit and cited then p end, ','), '') else coalesce(array_to_string(list_sort(list(distinct p) filter (where hit and not cited)), ','), '') end as found_on
        from x group by value_id""",
    "j9_ranges": """
        select l_orderkey, l_linenumber, array_to_string(list_sort(list_distinct(list_append(range(l_linenumber, l_linenumber + 4), l_quantity::bigint))), ',') as pages from lineitem""",
    "u1_except_all": """
        with a as (select o_orderpriority as p, o_orderstatus as s from orders), b as (select case when o_orderkey % 10 = 1 then 'X' else o_orderpriority end as p, o_orderstatus as s from orders where o_orderkey % 4 <> 0)
        select p, s, side, count(*) as n from (select *, 'old' as side from (select * from a except all select * from b) union all select *, 'new' from (select * from b except all select * from a)) group by all""",
    "u2_symmetric": """
        with a as (select distinct o_custkey as k from orders where o_orderstatus = 'F'), b as (select distinct o_custkey as k from orders where o_orderstatus = 'P')
        select k, 'a' as side from (select k from a except select k from b) union all select k, 'b' from (select k from b except select k from a)""",
    "u3_intersect": "select c_nationkey as k from customer intersect select s_nationkey from supplier",
    "u4_union_mixed": "select c_name as name, c_mktsegment as segment, null::double as balance from customer union all select s_name, null, s_acctbal from supplier",
    "k7_upsert": """
        select c_custkey, state, "at" from (select *, row_number() over (partition by c_custkey order by "at" desc, s desc) as rn from (
            select c_custkey, c_mktsegment as state, 0 as "at", 0 as s from customer union all select o_custkey, o_orderpriority, o_orderkey::int, 1 from orders)) where rn = 1""",
    "o1_key_order": "select p_partkey::varchar as k, p_name from part order by length(p_partkey::varchar) desc, p_partkey::varchar desc limit 10",
    "t1_routing": """
        with p as (select page_id, lower(coalesce(page_text, '')) as t from page_texts),
        h as (select page_id, length(regexp_replace(t, '[\\s\\pZ]', '', 'g')) as size, contains(t, 'pump model')::int + contains(t, 'checksum')::int as a, contains(t, 'well data')::int + contains(t, 'gas fraction')::int as b, contains(t, 'design summary')::int as c from p),
        n as (select *, (a = 2)::int + (b = 2)::int + (c = 1)::int as k from h)
        select page_id, case when size < 20 then 'no_text' when k = 1 then case when a = 2 then 'A' when b = 2 then 'B' else 'C' end when k > 1 then 'ambiguous' else 'unknown' end as family, k as n_families,
            case when k = 0 and a >= 1 then 'A' when k = 0 and b >= 1 then 'B' end as near from n""",
    "t5_keep_pages": """
        select page_id, coalesce(role0, last_value(role0 ignore nulls) over (w rows between unbounded preceding and 1 preceding)) as role, kept,
            case when kept then sum(kept::int) over w end::bigint as new_no, length(regexp_replace(coalesce(page_text, ''), '[\\s\\pZ]', '', 'g')) < 150 as low_yield
        from (select *, roles[1] as role0, not (coalesce(len(roles), 0) > 0 and len(list_filter(roles, lambda r: r is distinct from 'gas_page')) = 0) as kept from page_texts)
        window w as (partition by report_id order by page_no, page_id)""",
    "rule_engine": f"with {_FINDINGS} select rule_id, severity, table_name, column_name, count(*) as n from f group by all",
    "rule_status": f"""
        with {_FINDINGS} select row_key, count(*) as n, case when bool_or(severity = 'HALT') then 'failed' when bool_or(severity in ('ERROR', 'WARN')) then 'needs_review' else 'ok' end as status
        from f where table_name = 'lineitem' group by row_key""",
    "r1_reasons": f"""
        with {_FINDINGS}, t as (
            select row_key, severity || ':' || rule_id as t from f where table_name = 'orders' and column_name = 'o_totalprice'
            union select cast(o_orderkey as varchar), 'QUARANTINE:not_numeric' from orders where o_orderkey % 11 = 0
            union select cast(o_orderkey as varchar), 'INFO:T1' from orders)
        select row_key, string_agg(t, ',' order by t) as reasons, bool_or(t not like 'INFO:%') as needs_review from t group by row_key""",
    "r4_proposal": """
        with cells as (unpivot (select source_document, scenario_ordinal, manufacturer, vendor_family from stg_pump_config where source_document is not null and scenario_ordinal is not null) on manufacturer, vendor_family into name "column" value v),
        least as (select source_document, scenario_ordinal, "column", min(v) as value from cells group by all)
        select source_document, "column", arg_min(value, {'o': scenario_ordinal <> '1', 'l': length(scenario_ordinal), 's': scenario_ordinal}) as value, count(distinct value) as n_values, count(distinct value) > 1 as varies,
            string_agg(scenario_ordinal || '=' || value, '; ' order by scenario_ordinal || '=' || value) as all_values from least group by source_document, "column" """,
    "r14_stale": """
        select event_id, case when event_type = 'view' then case when ts + interval 15 minutes < timestamp '2024-01-20' then 'stale' else 'running' end else 'completed' end as state from events""",
    "st_latest": """
        select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1""",
    "st_confirm": """
        select cast(o_orderkey as varchar) as confirmation_id, o_custkey, coalesce(nullif(concat_ws(',', case when o_custkey is null then 'customer' end,
            case when not coalesce(o_totalprice > 1000, false) then 'price' end, case when not coalesce(o_orderstatus <> 'P', false) then 'closed' end), ''), 'accepted') as result from orders""",
    "st_close_once": "select user_id, ts, event_id from (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn = 1",
    "st_object_records": """
        select distinct strftime(ts, '%Y%m%dT%H%M%S') || '-' || substr(sha256('in/' || user_id || '@' || event_type), 1, 8) as run_id, 'in/' || user_id as key, event_type as version from events""",
    "st_transcription": """
        with q as (select user_id as key, min(ts) as moment from events group by 1), r as (select user_id as key, arg_min(case when value > 50 then 'succeeded' else 'failed' end, {'t': ts, 's': case when value > 50 then 'succeeded' else 'failed' end}) as state from events where event_type = 'purchase' group by 1)
        select key, coalesce(state, case when floor(epoch(timestamp '2024-01-20')) - floor(epoch(moment)) > 7 * 86400 then 'timed_out' else 'running' end) as state from q left join r using (key)""",
    "s4_jsonl": """
        with l as (select block, trim(raw_line, ' ') as t from raw_lines where source_file like '%.md' and raw_line is not null)
        select block, count(*) as n, count_if(not coalesce(t like '{%' and t like '%}' and json_valid(t), false))::bigint as n_broken from l where t <> '' and t not like '```%' group by block""",
    "d9_causes": """
        with o as (select source_document as s, concat_ws('/', scenario_ordinal, section_order) as k, min(stages) as v from stg_pump_config where source_document is not null group by all having min(stages) is not null),
        n as (select source_document as s, concat_ws('/', scenario_ordinal, section_order) as k, min(stages) as v from stg_pump_config_copy where source_document is not null group by all having min(stages) is not null)
        select case when exists (select 1 from n where n.s = o.s and n.v = o.v) then 'moved' when m.v is null then 'missing' when regexp_extract(o.v, '[\\d.,]+') <> '' and try_cast(replace(regexp_extract(o.v, '[\\d,]*\\.?\\d+'), ',', '') as double) = try_cast(replace(regexp_extract(m.v, '[\\d,]*\\.?\\d+'), ',', '') as double)
            and (trim(regexp_replace(lower(o.v), '[\\d.,()]+', ' ', 'g')) = trim(regexp_replace(lower(m.v), '[\\d.,()]+', ' ', 'g')) or not regexp_matches(o.v, '[a-z]') or not regexp_matches(m.v, '[a-z]')) then 'format' else 'genuine' end as cause, count(*) as n
        from o left join n m on m.s = o.s and m.k = o.k where o.v is distinct from m.v group by 1""",
    "e9_unknown_models": """
        with n as (select distinct pump_model_as_printed as p from stg_pump_config), c as (select pump_model_canonical as m, bool_or(curve_basis is not null) as curve from pump_catalogue where pump_model_canonical is not null group by 1),
        ke as (select m, regexp_replace(lower(m), '[^\\pL\\pN\\pM]', '', 'g') as key, lower(trim(m)) as ck from c),
        a as (select p, coalesce((select list(m) from ke where m = p), (select list(m) from ke where ck = lower(trim(p))), (select list(m) from ke where key = nullif(regexp_replace(lower(p), '[^\\pL\\pN\\pM]', '', 'g'), ''))) as hits from n),
        k as (select case when p is null or trim(p) = '' then 'unresolved' when len(hits) > 1 then 'ambiguous' when hits is null then 'absent' when not (select curve from c where m = hits[1]) then 'no_head_curve' end as class from a)
        select class, count(*) as n from k where class is not null group by class""",
    # record-level operators
    "rec_collapse": """
        with r as (select *, o_orderstatus = 'O' as open, case when o_custkey % 5 <> 0 then o_orderpriority end as p from orders)
        select o_custkey, arg_min(p, {'d': o_orderdate, 'k': o_orderkey}) as o_orderpriority, bool_and(open) as all_open, min(o_totalprice) as min_o_totalprice, max(o_totalprice) as max_o_totalprice from r group by o_custkey""",
    "rec_merged_json": """
        with c as (select user_id, ts, event_id, unnest(json_keys(props)) as k, json_extract_string(props, unnest(json_keys(props))) as v from events), l as (select user_id, k, arg_max(v, {'t': ts, 'e': event_id}) as v from c group by all)
        select user_id, '{' || string_agg('"' || k || '":"' || v || '"', ',' order by k) || '}' as merged from l group by user_id""",
    "rec_preferred": """
        select config_id, coalesce(top_md_ft, bottom_md_ft) as value, case when top_md_ft is not null then 'top' when bottom_md_ft is not null then 'bottom' end as source,
            case when top_md_ft is not null and bottom_md_ft is not null then 'bottom=' || bottom_md_ft else '' end as others from stg_pump_config""",
    "rec_envelope": """
        with e as (select context_id, try_cast(bubble_point_psi as double) as v, case when bubble_point_unit_as_printed in ('psi', 'psia') then 'psi' else bubble_point_unit_as_printed end as u, coalesce(bubble_point_provenance, 'document') as s from esp_well_design_context)
        select context_id, case when v is null then 'no_value' when u is null then 'no_unit' when u <> 'psi' then 'wrong_unit' when s not in ('document', 'measured', 'correlation', 'assumed') then 'unknown_source' end as problem from e""",
    "rec_flattened": "select page_id::varchar as page_id, page_no::varchar as page_no, array_to_string(roles, '; ') as roles from page_texts",
    "rec_key_parts": """
        select distinct source_file, case when m then regexp_extract(source_file, '^(wl|rpt)-', 1) end as kind, case when m then regexp_extract(source_file, '-(\\d+)\\.', 1) end as number, case when m then regexp_extract(source_file, '\\.(csv|md)$', 1) end as ext
        from (select source_file, regexp_full_match(source_file, '(wl|rpt)-(\\d+)\\.(csv|md)') as m from raw_lines)""",
    "rec_keys_like": "select key, count(*) as n, count(distinct v) as n_values from (select unnest(json_keys(props)) as key, json_extract_string(props, unnest(json_keys(props))) as v from events) where key like 'k%' group by key",
    "e13_without_names": """
        select organization_id, count(*) as n from well_list where well_id is null or not (contains(regexp_replace(lower(well_id), '[^\\pL\\pN]', '', 'g'), 'orrinbench') or contains(regexp_replace(lower(well_id), '[^\\pL\\pN]', '', 'g'), 'isfjell')) group by organization_id""",
    "a11_sum_check": """
        with l as (select l_orderkey as k, l_quantity::decimal(12,1) as q from lineitem),
        s as (select k, count(*) as n, sum(q) as s, 0.05 * count(*) as t, sum(q) + (k % 4 = 0)::int as total, count(*) + (k % 7 = 0)::int as expected from l group by k)
        select k, case when n < expected then 'missing_part' when abs(s - total) <= t then 'pass' else 'fail' end as result, n, s::double as sum, t::double as tolerance from s""",
    "a14_poisoned_sum": "select source, case when count(n_chars) = count(*) then sum(n_chars)::bigint end as total, count(*) as n from documents group by source",
    "a18_label_conflicts": """
        with r as (select source_document, scenario_ordinal, section_role as l, 'stg_pump_config' as t from stg_pump_config union all select source_document, scenario_ordinal, section_role, 'stg_pump_config_copy' from stg_pump_config_copy)
        select source_document, scenario_ordinal, string_agg(distinct l, '|' order by l) as labels, string_agg(distinct t, '|' order by t) as tables from r
        where scenario_ordinal is not null and l is not null group by source_document, scenario_ordinal having count(distinct l) > 1""",
    "a20_coverage": """
        with c as (unpivot (select vendor_family, source_document, manufacturer, section_role, stages, top_md_ft, stages_per_housing_as_printed from stg_pump_config where vendor_family is not null and source_document is not null)
            on manufacturer, section_role, stages, top_md_ft, stages_per_housing_as_printed into name "column" value v),
        t as (select vendor_family, count(distinct source_document) as n_records from c group by 1)
        select vendor_family, "column", count(distinct source_document) as n_with, any_value(n_records) as n_records, round(count(distinct source_document) / any_value(n_records), 6) as share from c join t using (vendor_family) group by 1, 2""",
    "a20_expected_missing": """
        with c as (unpivot (select vendor_family, source_document, manufacturer, section_role, stages, top_md_ft from stg_pump_config where vendor_family is not null and source_document is not null)
            on manufacturer, section_role, stages, top_md_ft into name "column" value v),
        t as (select vendor_family, count(distinct source_document) as n from c group by 1), u as (select vendor_family, "column" from c join t using (vendor_family) group by 1, 2 having round(count(distinct source_document) / any_value(n), 6) >= 0.7)
        select distinct d.vendor_family, d.source_document, u."column" from (select distinct vendor_family, source_document from c) d join u using (vendor_family)
        where not exists (select 1 from c where c.vendor_family = d.vendor_family and c.source_document = d.source_document and c."column" = u."column")""",
    "a22_rates": """
        select user_id, count(*) as n, round(count(*) * 1000.0::double / nullif(greatest(floor(epoch(max(ts))) - floor(epoch(min(ts))), 0), 0), 4) as per_1000s from events group by user_id""",
    "w12_misplaced": """
        select config_id, position::int as position, not coalesce(try_cast(section_order as int) = position, false) as misplaced from (
            select *, row_number() over (partition by source_document, scenario_ordinal order by section_order nulls first, config_id) as position from stg_pump_config)""",
    "w13_latest_committed": "select o_custkey, arg_max(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) as o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_linestatus = 'F') group by o_custkey",
    "j4_cascade_match": """
        with a as (select l_orderkey % 500 as k, l_linestatus, case when l_suppkey % 3 = 0 then l_returnflag end as flag from lineitem),
        o as (select k, l_linestatus, flag, count(*) as n from a where k % 7 <> 0 group by all), n as (select k, l_linestatus, case when k % 13 = 0 then 'Z' else flag end as flag, count(*) as n from a where k % 11 <> 0 group by all),
        j as (select coalesce(o.k, n.k) as k, coalesce(o.l_linestatus, n.l_linestatus) as l_linestatus, coalesce(o.flag, n.flag) as flag, coalesce(o.n, 0) as n_old, coalesce(n.n, 0) as n_new
            from o full join n on o.k = n.k and o.l_linestatus = n.l_linestatus and o.flag is not distinct from n.flag),
        b as (select k, l_linestatus from j where n_old = 0 or n_new = 0 group by all having max(n_old) > 0 and max(n_new) > 0)
        select j.*, case when n_old = n_new then 'matched' when n_old > 0 and n_new > n_old then 'split' when n_old > 0 and n_new > 0 then 'merged' when b.k is not null then 'regrouped' when n_new = 0 then 'missing' else 'extra' end as kind
        from j left join b on b.k = j.k and b.l_linestatus = j.l_linestatus""",
    "d8_parity": f"""
        with {_VERSIONS}, x as (select *, 'o' as s from (select * from old except all select * from new) union all select *, 'n' from (select * from new except all select * from old))
        select count_if(s = 'o' and name not like '%3')::bigint as only_old, count_if(s = 'n' and name not like '%3')::bigint as only_new, count_if(name like '%3')::bigint as allowed from x""",
    "d11_new_items": "select distinct o_custkey, o_orderpriority from orders where (o_custkey, o_orderpriority) not in (select o_custkey, o_orderpriority from orders where o_orderdate < date '1998-01-01')",
    "r17_series": """
        with t as (select vendor_family, point_type, try_cast(replace(flow_as_printed, ',', '') as double) as x, try_cast(replace(head_as_printed, ',', '') as double) as y from stg_curve_observations)
        select vendor_family, point_type, count(*) as n, count_if(x is not null and y is not null)::bigint as n_drawn, min(case when y is not null then x end) as x_min, max(case when y is not null then x end) as x_max,
            case when count_if(x is not null and y is not null) = 0 then 'nothing_to_draw' end as skipped from t group by all""",
    "r16_queue_state": """
        select event_id, case when user_id % 3 >= 2 then 'queued' when floor(epoch(timestamp '2024-01-20')) - floor(epoch(ts)) > 300 then 'delayed' else 'starting' end as state from events""",
    "r25_unique_labels": "select p_partkey, p_brand, case when count(*) over (partition by p_brand) > 1 then p_brand || ' (' || row_number() over (partition by p_brand order by p_partkey) || ')' else p_brand end as label from part",
    # the general problems
    "p4_found": f"with {_CHAINS} select organization_id, well_id, valid_from, valid_to from chains",
    "p4_history": f"with {_CHAINS} select organization_id, well_id, s.a as intake_set_depth_md_ft, s.b as motor_type, s.c as motor_nameplate_hp, s.d as oil_api_deg, s.e as water_cut_design_frac, s.f as design_frequency_hz, valid_from, valid_to from chains",
    "p5_found": _DIFF,
    "p5_verdict": f"select field_name, category, count(*) as n from ({_DIFF}) group by all",
    "p5_repeated": """
        with b as (select 'only_ref' as side, source_document, scenario_ordinal, section_role, pump_model_as_printed from stg_pump_config union all select 'only_port', source_document, scenario_ordinal, section_role, pump_model_as_printed from stg_pump_config_copy),
        k as (select side, count(*) as n, count(distinct {'a': section_role, 'b': pump_model_as_printed}) as u from b group by side, source_document, scenario_ordinal)
        select side, count(*) as n_keys, sum(n)::bigint as n_rows from k where u > 1 group by side""",
    "p5_fields": f"""
        with {_SIDES}
        select r.source_document, r.scenario_ordinal, r.section_order, '*' as field_name, 'only_ref' as category, null::varchar as old, null::varchar as new from r where not exists (select 1 from p where {_SAME})
        union all select p.source_document, p.scenario_ordinal, p.section_order, '*', 'only_port', null, null from p where not exists (select 1 from r where {_SAME})
        union all {" union all ".join(_field_category(f, f in _NUMERIC, True) for f in _FIELDS)}""",
    "p6_found": f"with {_REFS} select * from orphan",
    "p6_partial": f"""
        with {_REFS},
        half as (select r.table_name, r.row_id, r.ts, min(l.listed_at) as first, coalesce(bool_or(l.listed_at <= r.ts and (l.removed_at is null or r.ts < l.removed_at)), false) as alive
            from refs r left join (select distinct well_id, listed_at, removed_at from well_list) l on l.well_id = r.w where r.o is null and r.w is not null group by all
            union all
            select r.table_name, r.row_id, r.ts, min(l.listed_at), coalesce(bool_or(l.listed_at <= r.ts and (l.removed_at is null or r.ts < l.removed_at)), false)
            from refs r left join (select distinct organization_id, listed_at, removed_at from well_list) l on l.organization_id = r.o where r.w is null and r.o is not null group by all),
        found as (select table_name, period, orphan_kind from orphan union all select table_name, strftime(ts, '%Y-%m'), case when first is null then 'missing' when first > ts then 'late' else 'deleted' end from half where not alive)
        select table_name, period, orphan_kind, count(*) as n_rows from found group by all""",
    "p6_report": f"with {_REFS} select table_name, period, orphan_kind, count(*) as n_rows from orphan group by all",
}
