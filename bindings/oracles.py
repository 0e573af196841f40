"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

# --- shared SQL pieces ---------------------------------------------------------------------------

TOKENS = r"regexp_extract_all(lower({}), '\p{{L}}\p{{N}}+(?:\.\p{{N}}+)+|[\p{{L}}\p{{N}}]+')"


def tokens(text: str) -> str:
    return TOKENS.format(text)


def lexeme_rows(keys: str, source: str) -> str:
    """Rows (keys, lexeme, pos, weight) from ``source`` (keys, tok, pos, weight)."""
    return f"""
select {keys}, unnest(list_distinct(case when contains(tok, '.')
                        then list_concat([tok], string_split(tok, '.')) else [tok] end)) as lexeme,
       cast(pos as bigint) as pos, weight
from {source}"""


# --- fixed values: the classic English stop list ---
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more "
    "most other some such no nor not only own same so than too very s t can will just don "
    "should now"
).split()
# --- end of fixed values ---
STOPPED = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"


FEEDS = """
select l_suppkey as code, l_returnflag as source, l_partkey as target, l_linenumber as priority
from lineitem where l_linestatus = 'F'
union
select l_suppkey, l_returnflag, l_partkey, case when l_discount > 0.05 then 1 else 2 end
from lineitem where l_linestatus = 'O'
"""

DESCRIBED = """
described as (
  select o.o_orderkey, o.o_custkey, o.o_orderstatus <> 'P' as active, cast(o.o_orderdate as date) as effective_time,
         'the ' || o.o_orderpriority || ' of ' || o.o_orderkey || ' ' || o.o_orderstatus as term,
         case when o.o_totalprice < 100000 then 0 when o.o_totalprice < 200000 then 2 else 1 end as case_sig,
         case when m.preferred and o.o_orderpriority = '1-URGENT' then 'F'
              when m.preferred and o.o_orderpriority = '2-HIGH' then 'P'
              when m.acceptable and o.o_orderpriority = '2-HIGH' then 'S'
              when m.l_orderkey is not null and o.o_orderpriority = '3-MEDIUM' then 'D' end as identifier
  from orders o left join (
    select l_orderkey, bool_or(l_returnflag = 'A') as preferred, bool_or(l_returnflag = 'N') as acceptable
    from lineitem where l_linestatus = 'O' and not (l_tax > 0.06) group by l_orderkey) m
  on m.l_orderkey = o.o_orderkey)"""

CONCEPTS = f"""
{DESCRIBED},
names as (
  select *, row_number() over (partition by o_custkey order by effective_time desc, o_orderkey) as pick
  from described where active and identifier = 'F'),
concepts as (
  select row_number() over (order by c.c_custkey) as id, c.c_custkey as key, cast(c.c_custkey as varchar) as code,
         n.term as description, n.case_sig
  from customer c join names n on n.o_custkey = c.c_custkey and n.pick = 1
  where c.c_acctbal > 0)"""

CODE_LISTS = """
best as (
  select code, source, target, min(priority) as priority from (
    select cast(o_custkey as varchar) as code,
           case o_orderstatus when 'F' then 'OPCS4' when 'O' then 'ICD-10' else 'ReadCodeV2' end as source,
           'T' || o_orderkey || '.1' as target, cast(substr(o_orderpriority, 1, 1) as integer) as priority
    from orders where o_totalprice > 50000
    union all
    select cast(o_custkey as varchar), case when o_orderstatus = 'P' then 'ReadCodeV2' else 'ReadCodeV3' end,
           case when o_orderstatus = 'P' then 'T' || o_orderkey || '.1' else 'V' || o_orderkey end,
           case when o_orderstatus = 'F' then 1 else 2 end
    from orders where o_totalprice > 250000
    union all
    select cast(c_custkey as varchar), 'MeSH', c_mktsegment, 0 from customer where c_acctbal > 1000
    union all
    select cast(c_custkey as varchar), 'MeSH', c_name, 1 from customer where c_acctbal > 1000)
  group by all),
lists as (
  select code, source, list(target order by priority, target) as codes from best group by code, source)"""

VECTOR_PARTS = f"""
parts as (
  select code, 0 as part, 0 as sub, code as txt from concepts
  union all select code, 1, 0, description from concepts
  union all select c.code, 2, d.o_orderkey, d.term from concepts c join described d on d.o_custkey = c.key
            where d.active and d.identifier in ('P', 'S')
  union all select c.code, case l.source when 'MeSH' then 3 when 'OPCS4' then 4 when 'ICD-9' then 5
                                 when 'ICD-10' then 6 when 'ReadCodeV2' then 7 else 8 end,
                   0, array_to_string(l.codes, ' ')
            from concepts c join lists l on l.code = c.code),
lexed as (select *, {tokens("txt")} as toks from parts),
placed_parts as (
  select *,
    coalesce(sum(len(toks)) over w, 0) as search_at,
    coalesce(sum(case when part = 2 then len(toks) else 0 end) over w, 0) as synonyms_at,
    coalesce(sum(case when part in (1, 2) then 0 else len(toks) end) over w, 0) as relation_at
  from lexed
  window w as (partition by code order by part, sub rows between unbounded preceding and 1 preceding)),
each_token as (
  select code, part, search_at, synonyms_at, relation_at,
         unnest(toks) as tok, unnest(range(1, len(toks) + 1)) as place from placed_parts),
has_synonyms as (select distinct code from parts where part = 2),
entries as (
  select code, 'search' as vector, tok, place + search_at as pos, case when part < 2 then 'A' else 'B' end as weight
  from each_token where code in (select code from has_synonyms)
  union all select code, 'synonyms', tok, place + synonyms_at, 'D' from each_token where part = 2
  union all select code, 'relation', tok, place + relation_at, case when part = 0 then 'A' else 'B' end
            from each_token where part not in (1, 2))"""

PARTIES = """
select 'R' || r_regionkey as code, r_name as name from region
union all select 'N' || n_nationkey, n_name from nation
union all select 'C' || c_custkey, c_name from customer
"""

GRAMS = r"""
list_distinct(flatten(list_transform(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+'),
  lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""

TRIGRAMS = f"""
with g as (select p_partkey, {GRAMS.format("p_name")} as a, {GRAMS.format("'red widgit'")} as b from part),
s as (select p_partkey, len(list_intersect(a, b))::double / len(list_distinct(list_concat(a, b))) as sim from g)
select p_partkey, round(sim, 6) as sim from s where sim >= 0.3"""

WEIGHTED = f"""
with t as (select p_partkey, {tokens("p_brand")} as ta, {tokens("p_name")} as tb from part)
select p_partkey, unnest(ta) as lexeme, unnest(range(1, len(ta) + 1)) as pos, 'A' as weight from t
union all
select p_partkey, unnest(tb), unnest(range(len(ta) + 1, len(ta) + len(tb) + 1)), 'B' from t"""

MD5 = "md5(cast(p_partkey as varchar))"

ORACLES = {
    "tsv_scan": """
select o_orderkey as id, cast(o_orderdate as date) as effective_time, o_orderstatus <> 'P' as active,
       o_custkey as concept_id, o_orderstatus as type_id, '"' || o_orderpriority || '" \\ end' as term
from orders""",
    "release_scan": """
select l_orderkey as id, cast(l_shipdate as date) as effective_time, l_linestatus = 'O' as active,
       cast(l_partkey as varchar) as source_id, cast(l_suppkey as varchar) as destination_id,
       cast(l_linenumber as varchar) as relationship_group_id, '' as type_id
from lineitem
union all
select o_orderkey, cast(o_orderdate as date), o_orderstatus = 'O', cast(o_custkey as varchar), '', '', o_orderpriority
from orders""",
    "manifest_scan": """
select cast(o_custkey as varchar) as name, cast(o_orderkey as varchar) as id,
       strftime(o_orderdate, '%Y-%m-%d') as "releaseDate", o_orderkey as size
from (select *, row_number() over (partition by o_custkey order by cast(o_orderdate as date) desc, o_orderkey desc) n
      from orders) where n = 1""",
    "stored_table": "select p_partkey, p_type, p_size from part",
    "refilled_table": "select p_partkey, p_type from part where p_type <> 'SMALL'",
    "smallest_largest": """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, least(l_partkey, l_suppkey, l_orderkey) as smallest,
       greatest(l_partkey, l_suppkey, l_orderkey) as largest
from lineitem""",
    "array_texts": """
select p_partkey, case when p_type in ('PROMO', 'LARGE') then '' else p_name || ', x ' || p_type end as codes,
       case when p_type in ('PROMO', 'LARGE') then 0 else 2 end as n
from part""",
    "date_decode": "select o_orderkey, cast(o_orderdate as date) as effective_time from orders",
    "uuid_decode": f"""
select p_partkey, case when p_type = 'PROMO' then null else
  substr({MD5}, 1, 8) || '-' || substr({MD5}, 9, 4) || '-' || substr({MD5}, 13, 4) || '-' ||
  substr({MD5}, 17, 4) || '-' || substr({MD5}, 21, 12) end as id
from part""",
    "layout_union": """
select s_suppkey as id, s_name as name, s_nationkey as nation, 1 as map_priority, '' as segment from supplier
union all select c_custkey, c_name, c_nationkey, c_nationkey, c_mktsegment from customer""",
    "external_codemap": """
with e as (
  select p_brand as code, cast(p_partkey as varchar) as target, 0 as place from part
  union all select p_brand, p_name || ', \\ or "so"', 1 from part
  union all select p_brand, null, 2 from part),
b as (select code, target, min(place) as place from e group by all)
select code, 'MeSH' as source, target, row_number() over (partition by code order by place, target) as ord from b""",
    "delimited_roundtrip": """
select c_custkey, ' "' || c_name || '",' || chr(10) || c_mktsegment as label,
       case when c_acctbal < 0 then null else c_mktsegment end as segment
from customer""",
    "quoted_documents": "select doc_id, md5(nullif(text, '')) as digest, nullif(lang, '') as lang from documents",
    "incremental_ingest": "select event_type, count(*) as n from events group by 1",
    "drop_empty_id": "select p_partkey, p_name from part where p_type <> 'SMALL'",
    "origin_lookup": """
select p.p_partkey, p.p_name as map_target, m.origin
from part p join (values ('ECONOMY', 'OPCS4'), ('STANDARD', 'ICD-10'), ('PROMO', 'ReadCodeV2'),
                         ('LARGE', 'ReadCodeV3')) m(t, origin) on p.p_type = m.t
where p.p_size >= 5 and p.p_size <= 45""",
    "ctv_origin": """
select l_orderkey, l_linenumber, cast(l_partkey as varchar) as map_target,
       case when l_returnflag = 'N' then 'ReadCodeV2' else 'ReadCodeV3' end as map_origin
from lineitem where l_discount <> 0""",
    "map_priority": """
select l_orderkey, l_linenumber, l_partkey, case when l_linestatus = 'O' then 1 else 2 end as priority from lineitem""",
    "case_sig": """
select o_orderkey, case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 2 else 1 end as case_sig from orders""",
    "json_field": "select event_id, json_extract_string(props, '$.k') as k from events",
    "category_filter": "select p_partkey, p_size from part where (p_size & 6) = 6",
    "snake_case": """
select c_custkey, lower(array_to_string(regexp_extract_all(c_name || c_mktsegment, '[A-Z][a-z]*'), '_')) as safe
from customer""",
    "clamp": "select p_partkey, least(greatest(p_size, 10), 40) as clamped from part",
    "latest_release": """
select event_type, event_id, ts
from (select *, row_number() over (partition by event_type order by ts desc, event_id desc) n from events) where n = 1""",
    "classify_description": f"with {DESCRIBED} select o_orderkey, identifier from described",
    "concept_terms": """
select row_number() over (order by c.c_custkey, d.o_orderkey) as id, cast(c.c_custkey as varchar) as code, d.o_orderkey
from customer c join orders d on c.c_custkey = d.o_custkey where c.c_acctbal > 0 and d.o_orderstatus <> 'P'""",
    "named_concept": f"with {CONCEPTS} select id, code, description, case_sig from concepts",
    "map_union": f"select * from ({FEEDS}) where code in (select s_suppkey from supplier where s_acctbal > 0)",
    "map_components": f"""
select code, source, target, priority from (
  select *, rank() over (partition by code, source, target order by priority) n from ({FEEDS})) where n = 1""",
    "codemap": f"""
with b as (select code, source, target, min(priority) as priority from ({FEEDS}) group by all)
select code, source, target, row_number() over (partition by code, source order by priority, target) as ord from b""",
    "codemap_pivot": """
with m as (
  select o_custkey as code, o_orderpriority as source, o_orderkey as target,
         case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as priority from orders),
o as (select *, row_number() over (partition by code, source order by priority, target) as ord from m),
k as (
  select code, (ord - 1) // 4 as page,
         string_agg(cast(target as varchar), ',' order by ord) filter (where source = '1-URGENT') as urgent,
         string_agg(cast(target as varchar), ',' order by ord) filter (where source = '2-HIGH') as high,
         string_agg(cast(target as varchar), ',' order by ord) filter (where source = '3-MEDIUM') as medium,
         string_agg(cast(target as varchar), ',' order by ord) filter (where source = '4-NOT SPECIFIED') as unset,
         string_agg(cast(target as varchar), ',' order by ord) filter (where source = '5-LOW') as low
  from o group by 1, 2)
select c_custkey as code, coalesce(page, 0) as page, urgent, high, medium, unset, low
from customer left join k on k.code = c_custkey""",
    "codelist_upsert": """
with o as (
  select o_custkey as code, o_orderkey as id, o_totalprice as value, o_orderstatus <> 'P' as active,
         cast(o_orderdate as date) as effective_time from orders),
cur as (select * from (
  select *, row_number() over (partition by code order by effective_time desc, id desc) n
  from o where effective_time < date '1996-01-01') where n = 1),
inc as (select * from (
  select *, row_number() over (partition by code order by effective_time desc, id desc) n
  from o where effective_time >= date '1996-01-01') where n = 1)
select coalesce(c.code, i.code) as code, coalesce(c.id, i.id) as id,
       case when c.code is null then i.value when i.active and i.effective_time > c.effective_time then i.value
            else c.value end as value,
       case when c.code is null then i.active when i.active and i.effective_time > c.effective_time then i.active
            else c.active end as active,
       coalesce(c.effective_time, i.effective_time) as effective_time
from cur c full join inc i on c.code = i.code""",
    "synonym_lexemes": f"""
with t as (select p_brand, p_partkey, {tokens("p_name")} as toks from part),
o as (select *, coalesce(sum(len(toks)) over (partition by p_brand order by p_partkey
             rows between unbounded preceding and 1 preceding), 0) as before from t),
e as (select p_brand, unnest(toks) as tok, unnest(range(1, len(toks) + 1)) + before as pos, 'D' as weight from o)
{lexeme_rows("p_brand", "e")}""",
    "weighted_vector": WEIGHTED,
    "joined_vector": WEIGHTED,
    "reweighted_vector": f"select p_partkey, lexeme, pos, 'C' as weight from ({WEIGHTED})",
    "document_vector": f"""
with t as (select doc_id, {tokens("text")} as toks from documents),
e as (select doc_id, unnest(toks) as tok, unnest(range(1, len(toks) + 1)) as pos, 'D' as weight from t)
{lexeme_rows("doc_id", "e")}""",
    "english_vector": f"""
with t as (select doc_id, {tokens("text")} as toks from documents),
e as (select doc_id, unnest(toks) as tok, unnest(range(1, len(toks) + 1)) as pos from t)
select doc_id, pos, case when contains(tok, '.') then cast(len(list_distinct(list_concat([tok], string_split(tok, '.')))) as bigint)
                         else 1 end as n
from e where tok not in {STOPPED}""",
    "english_stems": f"""
with w as (select ['consist', 'consol', 'conspicu', 'constanc', 'knackeri', 'knavish', 'knead', 'knive', 'knock', 'hop',
                   'generous', 'generat', 'cri', 'tie', 'happi', 'relat', 'adjust'] as stems),
t as (select doc_id, list_concat(stems, [source], ['', ''], [lang], stems) as lexemes from documents, w),
e as (select doc_id, unnest(lexemes) as lexeme, unnest(range(1, len(lexemes) + 1)) as pos, 'B' as weight from t)
select * from e where lexeme <> ''""",
    "english_part_vector": f"""
with t as (select p_partkey, {tokens("p_brand")} as ta, {tokens("'The ' || p_name || ' of ' || p_type")} as tb from part),
e as (
  select p_partkey, unnest(ta) as tok, unnest(range(1, len(ta) + 1)) as pos, 'A' as weight from t
  union all
  select p_partkey, unnest(tb), unnest(range(len(ta) + 1, len(ta) + len(tb) + 1)), 'B' from t)
select p_partkey, case tok when 'large' then 'larg' when 'economy' then 'economi' else tok end as lexeme, pos, weight
from e where tok not in ('the', 'of')""",
    "codelist_english": f"""
with {CONCEPTS}, {CODE_LISTS}, {VECTOR_PARTS}
select code, vector, case lexeme when 'automobile' then 'automobil' when 'machinery' then 'machineri'
                                 when 'furniture' then 'furnitur' when 'building' then 'build'
                                 when 'customer' then 'custom' else lexeme end as lexeme, pos, weight
from ({lexeme_rows("code, vector", "entries")}) where lexeme not in ('the', 'of')""",
    "codelist": f"""
with {CONCEPTS}, {CODE_LISTS},
wide as (
  select code,
         max(array_to_string(codes, ',')) filter (where source = 'MeSH') as mesh_codes,
         max(array_to_string(codes, ',')) filter (where source = 'OPCS4') as opcs4_codes,
         max(array_to_string(codes, ',')) filter (where source = 'ICD-9') as icd9_codes,
         max(array_to_string(codes, ',')) filter (where source = 'ICD-10') as icd10_codes,
         max(array_to_string(codes, ',')) filter (where source = 'ReadCodeV2') as readcv2_codes,
         max(array_to_string(codes, ',')) filter (where source = 'ReadCodeV3') as readcv3_codes
  from lists group by code)
select c.id, c.code, cast(0 as bigint) as page, c.description, c.case_sig, w.* exclude (code)
from concepts c left join wide w on w.code = c.code""",
    "codelist_lists": f"""
with {CONCEPTS}, {CODE_LISTS}
select l.code, l.source, unnest(range(1, len(l.codes) + 1)) as ord, unnest(l.codes) as target
from lists l where l.code in (select code from concepts)""",
    "codelist_vectors": f"""
with {CONCEPTS}, {CODE_LISTS}, {VECTOR_PARTS}
{lexeme_rows("code, vector", "entries")}""",
    "tag_vector": f"""
with {CONCEPTS}, {CODE_LISTS}, {VECTOR_PARTS},
own as (
  select code, max(len(toks)) filter (where part = 1) as description_n, max(len(toks)) filter (where part = 0) as code_n,
         sum(len(toks)) filter (where part not in (1, 2)) as relation_n
  from lexed group by code),
tag_entries as (
  select t.code, t.tok,
         t.place + case when t.part = 1 then 0 when t.part = 0 then o.description_n else 0 end as pos, 'A' as weight
  from each_token t join own o on o.code = t.code where t.part < 2
  union all
  select t.code, t.tok, t.place + t.relation_at + o.description_n + o.code_n, 'B'
  from each_token t join own o on o.code = t.code where t.part not in (1, 2)
  union all
  select t.code, t.tok, t.place + t.synonyms_at + o.description_n + o.code_n + o.relation_n, 'B'
  from each_token t join own o on o.code = t.code where t.part = 2)
{lexeme_rows("code", "tag_entries")}""",
    "ontology_tags": f"""
select row_number() over (order by code) as id, name, 0 as type_id,
       json_object('code', code, 'coding_system_id', 9)::varchar as properties
from ({PARTIES}) where code <> 'R0'""",
    "ontology_edges": f"""
with t as (select row_number() over (order by code) as id, code from ({PARTIES}) where code <> 'R0')
select c.id as child_id, p.id as parent_id
from (select 'N' || n_nationkey s, 'R' || n_regionkey d from nation
      union all select 'C' || c_custkey, 'N' || c_nationkey from customer) r
join t c on r.s = c.code join t p on r.d = p.code where 'R0' not in (r.s, r.d)""",
    "text_match": r"""
select p_partkey from part
where list_has_all(regexp_extract_all(lower(p_name), '[\p{L}\p{N}]+'), ['red', 'widget'])""",
    "posting_match": f"""
select doc_id from documents where list_has_all({tokens("text")}, ['and', 'the'])""",
    "array_lookup": f"select distinct code from ({FEEDS}) where source = 'A' and target in (5, 17, 99)",
    "list_overlap": """
select distinct o_custkey as code from orders where o_orderkey in (3, 17, 41, 99)""",
    "trigram_lookup": TRIGRAMS,
    "trigram_index_lookup": TRIGRAMS,
    "orphan_check": """
select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "reference_check": """
select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
where not exists (select 1 from supplier where s_suppkey = l_suppkey and s_acctbal > 0)""",
    "unique_check": """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1""",
    "bounds_check": "select p_partkey, cast(length(p_name) as integer) as len from part where length(p_name) > 10",
    "declared_bounds": """
select 'p_name' as "column", p_name as value, cast(length(p_name) as integer) as len, count(*) as n
from part where length(p_name) > 10 group by all
union all
select 'p_brand', p_brand, cast(length(p_brand) as integer), count(*) from part where length(p_brand) > 7 group by all
union all
select 'p_type', p_type, cast(length(p_type) as integer), count(*) from part where length(p_type) > 25 group by all""",
    "enum_check": "select o_orderkey, o_orderstatus from orders where o_orderstatus not in ('F', 'O')",
    "foreign_key": """
select o.o_orderkey, o.o_custkey from orders o
where not exists (select 1 from customer c where c.c_custkey = o.o_custkey and c.c_acctbal > 0)""",
}

ORACLES["release_codelist"] = ORACLES["codelist"]

TAGS = f"""
{CONCEPTS},
tags as (select row_number() over (order by code) as id, code, description as name, id as code_id from concepts)"""

ORACLES["built_tags"] = f"""
with {TAGS}
select id, code, name, 0 as type_id,
       json_object('code', code, 'code_id', code_id, 'coding_system_id', 9)::varchar as properties
from tags"""

ORACLES["built_edges"] = f"""
with {TAGS},
links as (select distinct cast(o_custkey as varchar) as child, cast(o_custkey // 10 as varchar) as parent
          from orders where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'),
e as (select c.id as child_id, p.id as parent_id from links join tags c on c.code = child join tags p on p.code = parent)
select row_number() over (order by child_id, parent_id) as id, child_id, parent_id from e"""

ORACLES["built_search"] = f"""
with {CONCEPTS}, {CODE_LISTS}, {VECTOR_PARTS},
found as ({lexeme_rows("code, vector", "entries")}),
grams as (select code, {GRAMS.format("description")} as a, {GRAMS.format("'the 1-URGENT of 100 F'")} as b from concepts)
select 'text' as kind, code from found where vector = 'search' and lexeme in ('1', 'urgent', 'the')
group by code having count(distinct lexeme) = 3
union all
select 'weight', code from found where vector = 'search' and weight = 'B' and lexeme in ('1', '2', 'high')
group by code having count(distinct lexeme) = 3
union all
select distinct 'any', code from found where vector = 'relation' and lexeme in ('t7', 'v3', 'machinery')
union all
select distinct 'target', l.code from lists l join concepts c on c.code = l.code
where source = 'MeSH' and list_has_any(codes, ['MACHINERY', 'BUILDING'])
union all
select 'similar', code from grams where len(list_intersect(a, b))::double / len(list_distinct(list_concat(a, b))) >= 0.6"""

ORACLES["reference_columns"] = """
with v as (
  select 'part' as "column", cast(l_partkey as varchar) as value from lineitem
  where l_partkey not in (select p_partkey from part)
  union all select 'supplier', cast(l_suppkey * 2 as varchar) from lineitem
  where l_suppkey * 2 not in (select s_suppkey from supplier)
  union all select 'source', cast(l_orderkey as varchar) from lineitem
  where l_orderkey not in (select o_orderkey from orders)
  union all select 'target', cast(l_orderkey + 7 as varchar) from lineitem
  where l_orderkey + 7 not in (select o_orderkey from orders))
select "column", value, count(*) as n from v group by all"""

ORACLES["replaced_table"] = "select p_partkey, p_type, p_size * 2 as p_size from part where p_size > 10"

ORACLES["merged_table"] = ORACLES["codelist_upsert"]

ORACLES["incremental_concepts"] = f"with {CONCEPTS} select code, description, case_sig from concepts"

ORACLES["incremental_lists"] = f"""
select code, source, ord, target from ({ORACLES["codelist_lists"]}) where source <> 'MeSH'"""

ORACLES["drop_load"] = """
select o_orderkey as id, cast(o_orderdate as date) as effective_time, o_orderstatus <> 'P' as active, o_custkey as concept_id,
       'the ' || o_orderpriority || ' of ' || o_orderkey || ' ' || o_orderstatus as term
from orders"""

ORACLES["tree_match"] = f"""
with t as (select doc_id, {tokens("text")} as toks from documents),
e as (select doc_id, unnest(toks) as tok, unnest(range(1, len(toks) + 1)) as pos, 'D' as weight from t),
x as ({lexeme_rows("doc_id", "e")}),
m as (
  select doc_id, bool_or(lexeme = 'la') as la, bool_or(starts_with(lexeme, 'que')) as que, bool_or(lexeme = 'is') as "is"
  from x group by doc_id),
near as (
  select distinct a.doc_id from x a join x b on a.doc_id = b.doc_id
  where (a.lexeme = 'of' and b.lexeme = 'the' and b.pos = a.pos + 1)
     or (a.lexeme = 'der' and b.lexeme = 'und' and b.pos = a.pos + 2))
select m.doc_id from m left join near using (doc_id) where (near.doc_id is not null or (la and que)) and not "is"
"""

ORACLES["pattern_match"] = """
select doc_id, 'like' as kind from documents where text like '%license%under%'
union all
select doc_id, 'rlike' from documents where regexp_matches(text, '(the|and) [a-z]*ation(al)? of')"""
