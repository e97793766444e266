"""The queries in DuckDB SQL."""

from __future__ import annotations

from .fixtures import BIZ, CODED

THRESHOLD = 0.62

# Fixed values, written down here for themselves, so that a wrong one in the engine shows.
#: Patterns of whole words in names and addresses, and what takes their place, in order.
_NAME_RULES = (
    (r"corporation", "corp"),
    (r"corp\.?", "corp"),
    (r"incorporated", "inc"),
    (r"inc\.?", "inc"),
    (r"limited", "ltd"),
    (r"ltd\.?", "ltd"),
    (r"private", "pvt"),
    (r"pvt\.?", "pvt"),
    (r"pte\.?", "pvt"),
    (r"llc\.?", "llc"),
    (r"l\.l\.c\.?", "llc"),
    (r"llp\.?", "llp"),
    (r"l\.l\.p\.?", "llp"),
    (r"company", "co"),
    (r"co\.?", "co"),
    (r"gmbh", "gmbh"),
    (r"sa", "sa"),
    (r"s\.a\.?", "sa"),
    (r"sarl", "sarl"),
    (r"s\.a\.r\.l\.?", "sarl"),
    (r"bv", "bv"),
    (r"b\.v\.?", "bv"),
    (r"plc", "plc"),
    (r"enterprises", "ent"),
    (r"technologies", "tech"),
    (r"technology", "tech"),
    (r"tech\.?", "tech"),
    (r"solutions", "soln"),
    (r"solution", "soln"),
    (r"services", "serv"),
    (r"service", "serv"),
    (r"international", "intl"),
    (r"intl\.?", "intl"),
    (r"group", "grp"),
    (r"holdings", "hldg"),
)
_ADDRESS_RULES = (
    (r"street", "st"),
    (r"st\.?", "st"),
    (r"road", "rd"),
    (r"rd\.?", "rd"),
    (r"avenue", "ave"),
    (r"ave\.?", "ave"),
    (r"boulevard", "blvd"),
    (r"blvd\.?", "blvd"),
    (r"drive", "dr"),
    (r"dr\.?", "dr"),
    (r"lane", "ln"),
    (r"ln\.?", "ln"),
    (r"floor", "fl"),
    (r"flr\.?", "fl"),
    (r"fl\.?", "fl"),
    (r"suite", "ste"),
    (r"ste\.?", "ste"),
    (r"apartment", "apt"),
    (r"apt\.?", "apt"),
    (r"building", "bldg"),
    (r"bldg\.?", "bldg"),
    (r"highway", "hwy"),
    (r"hwy\.?", "hwy"),
    (r"parkway", "pkwy"),
    (r"pkwy\.?", "pkwy"),
    (r"court", "ct"),
    (r"ct\.?", "ct"),
    (r"place", "pl"),
    (r"pl\.?", "pl"),
    (r"square", "sq"),
    (r"sq\.?", "sq"),
    (r"circle", "cir"),
    (r"cir\.?", "cir"),
    (r"number", "no"),
    (r"num\.?", "no"),
    (r"no\.?", "no"),
    (r"p\.?\s*o\.?\s*box", "pobox"),
    (r"post\s+office\s+box", "pobox"),
)
#: Countries' aliases.
_COUNTRIES = {"us": ("usa", "united states", "united states of america", "u s a", "u s"), "india": ("ind", "in", "republic of india"), "united kingdom": ("uk", "u k", "great britain"), "france": ("fra", "fr"), "germany": ("deu", "de"), "canada": ("can", "ca"), "australia": ("aus", "au")}
#: Name tokens that distinguish nothing.
STOP = ("and", "the", "of", "in", "at", "for", "on", "by", "to", "co", "corp", "inc", "ltd", "pvt", "llc", "llp", "gmbh", "sa", "serv", "tech", "soln")
#: Largest pools, and the sample of first tokens beyond.
CAPS = {"first": 200, "prefix": 150, "token": 100, "number": 100, "address": 60}
FIRST_SAMPLE, TOP_K, LEAST_COSINE, VOCABULARY = 50, 15, 0.35, 25_000
#: Names of the features, in order.
FEATURES = ("name_exact", "name_token_exact", "name_jaccard", "name_overlap", "name_common_tokens", "name_lev", "name_ngram2", "name_ngram3", "name_len_diff", "name_len_ratio", "addr_exact", "addr_jaccard", "addr_overlap", "addr_common_tokens", "addr_lev", "addr_ngram3", "addr_len_diff", "num_overlap", "num_common_count", "country_match", "country_conflict", "missing_s1_addr", "missing_c_addr", "is_source2", "is_source3", "composite_sim", "min_sim", "max_sim", "harmonic_sim")


def _rules(x: str, table: tuple[tuple[str, str], ...]) -> str:
    for pattern, short in table:
        x = f"regexp_replace({x}, '\\b{pattern}\\b', '{short}', 'g')"
    return x


_NAME = _rules(r"regexp_replace(regexp_replace(lower(raw_name), '\s*&\s*', ' and ', 'g'), '\s*\+\s*', ' and ', 'g')", _NAME_RULES)
_ALIAS = " ".join(f"when nc in ({', '.join(repr(t) for t in texts)}) then '{name}'" for name, texts in _COUNTRIES.items())
_TOKENS = r"list_filter(string_split_regex({}, '\s+'), lambda t: t <> '')"
_STOPS = "[" + ", ".join(repr(t) for t in STOP) + "]"

#: n: the record table.
RECORDS = rf"""with biz as ({BIZ.replace("{part}", "part")}),
r0 as (select id, source, k, raw_name, raw_address, raw_country, {_TOKENS.format(rf"regexp_replace(regexp_replace({_NAME}, '[^\w\s-]', ' ', 'g'), '[-_]', ' ', 'g')")} name_tokens,
  {_TOKENS.format(rf"regexp_replace({_rules('lower(raw_address)', _ADDRESS_RULES)}, '[^\w\s]', ' ', 'g')")} addr_tokens, regexp_extract_all(lower(raw_address), '\b\d+\b') numeric_tokens,
  regexp_replace(regexp_replace(trim(lower(raw_country)), '[^\w\s]', '', 'g'), '\s+', ' ', 'g') nc from biz),
n as (select id, source, k, raw_name, raw_address, raw_country, array_to_string(name_tokens, ' ') norm_name, name_tokens, array_to_string(addr_tokens, ' ') norm_address, addr_tokens, numeric_tokens, case {_ALIAS} else nc end norm_country from r0),
s1 as (select * from n where source = 'source1'), t as (select * from n where source <> 'source1'),
truth as (select 'S1_' || substr(id, 4, 8) s1_id, id target_id from t)"""

_PER_SIDE = f"""select id, norm_name, numeric_tokens, list_filter(name_tokens, lambda t: not list_contains({_STOPS}, t) and length(t) >= 2) sig, list_filter(addr_tokens, lambda t: length(t) >= 4 and not list_contains({_STOPS}, t)) adr from """


def _keys(side: str, n: int) -> str:
    return f"""select 'exact' pass, norm_name as key, id from {side} where norm_name <> '' union select 'first', sig[1], id from {side} where len(sig) > 0 union select 'prefix', substr(sig[1], 1, 3), id from {side} where length(sig[1]) >= 3
  union select 'token', x, id from (select id, unnest(sig) x from {side}) where length(x) >= 4 union select 'number', x, id from (select id, unnest(numeric_tokens) x from {side}) where length(x) >= 3 union select 'address', x, id from (select id, unnest(adr[1:{n}]) x from {side})"""


_CAP = " ".join(f"when '{p}' then {c}" for p, c in CAPS.items())
#: kp: pairs by pass; c: compatible pairs.
KEYS = f"""{RECORDS}, ps as ({_PER_SIDE} s1), pt as ({_PER_SIDE} t), ks as ({_keys("ps", 2)}), kt as ({_keys("pt", 3)}),
kn as (select *, count(*) over (partition by pass, key) pool, row_number() over (partition by pass, key order by id) nth from kt),
kk as (select pass, key, id from kn where pool <= case pass {_CAP} else 9e18 end or (pass = 'first' and pool > {CAPS["first"]} and nth <= {FIRST_SAMPLE})),
kp as (select distinct ks.pass, ks.id s1_id, kk.id target_id from ks join kk on ks.pass = kk.pass and ks.key = kk.key),
c as (select distinct s1_id, target_id from kp join s1 a on a.id = s1_id join t b on b.id = target_id where a.norm_country = '' or b.norm_country = '' or a.norm_country = b.norm_country or a.norm_name = b.norm_name)"""

_GRAMS = """select id, gram, count(*) tf from (select id, unnest(list_concat(list_transform(range(1, length(w)), lambda i: substr(w, i, 2)), list_transform(range(1, length(w) - 1), lambda i: substr(w, i, 3)), list_transform(range(1, length(w) - 2), lambda i: substr(w, i, 4)))) gram
  from (select id, ' ' || unnest(string_split(case when norm_name = '' then 'unknown' else norm_name end, ' ')) || ' ' w from {})) group by id, gram"""
TFIDF = f"""{KEYS}, gs as ({_GRAMS.format("s1")}), gt as ({_GRAMS.format("t")}),
st as (select gram, ln((1.0 + (select count(*) from t)) / (1.0 + count(*))) + 1.0 idf from gt group by gram order by sum(tf) desc, gram limit {VOCABULARY}),
vs as (select id, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by id)) w from gs join st using (gram)), vt as (select id, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by id)) w from gt join st using (gram)),
sm as (select vs.id s1_id, vt.id target_id, round(sum(vs.w * vt.w), 6) sim from vs join vt using (gram) group by 1, 2), nb as (select * from (select *, row_number() over (partition by s1_id order by sim desc, target_id) nth from sm where sim >= {LEAST_COSINE}) where nth <= {TOP_K})"""


def _indel(a: str, b: str) -> str:
    """2 * LCS / lengths, with bit vectors (texts of up to 120 characters)."""
    full = f"((1::hugeint << length({a})) - 1)"
    masks = f"list_transform(string_split({b}, ''), lambda c: list_reduce(list_transform(range(1, length({a}) + 1), lambda i: case when substr({a}, i, 1) = c then 1::hugeint << (i - 1)::int else 0::hugeint end), lambda x, y: x + y))"
    v = f"list_reduce({masks}, lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}, {full})"
    return f"case when {a} = {b} then 1.0 when {a} = '' or {b} = '' then 0.0 else 2.0 * (length({a}) - bit_count({v})) / (length({a}) + length({b})) end"


def _overlap(a: str, b: str) -> tuple[str, str, str]:
    common = f"len(list_intersect({a}, {b}))"
    both, one = f"len({a}) = 0 and len({b}) = 0", f"len({a}) = 0 or len({b}) = 0"
    ratio = lambda low: f"case when {both} then 1.0 when {one} then 0.0 else {common} / ({low}) end"
    return ratio(f"len(list_distinct({a})) + len(list_distinct({b})) - {common}"), ratio(f"least(len(list_distinct({a})), len(list_distinct({b})))"), f"{common}::double"


def _ngram(a: str, b: str, n: int) -> str:
    g = lambda x: f"list_distinct(list_transform(range(1, length({x}) - {n - 2}), lambda i: substr({x}, i, {n})))"
    common = f"len(list_intersect({g(a)}, {g(b)}))"
    return f"case when {a} = {b} then 1.0 when length({a}) < {n} or length({b}) < {n} then 0.0 else {common} / (len({g(a)}) + len({g(b)}) - {common}) end"


def _feature_sql() -> dict[str, str]:
    name, addr = _overlap("a.name_tokens", "b.name_tokens"), _overlap("a.addr_tokens", "b.addr_tokens")
    num = "len(list_intersect(a.numeric_tokens, b.numeric_tokens))"
    na, nb, aa, ab = "a.norm_name", "b.norm_name", "a.norm_address", "b.norm_address"
    unknown = "a.norm_country = '' or b.norm_country = ''"
    values = [
        f"({na} <> '' and {na} = {nb})::int::double", "(len(a.name_tokens) > 0 and a.name_tokens = b.name_tokens)::int::double", *name, _indel(na, nb), _ngram(na, nb, 2), _ngram(na, nb, 3),
        f"abs(length({na}) - length({nb}))::double", f"least(length({na}), length({nb})) / greatest(length({na}), length({nb}), 1)", f"({aa} <> '' and {aa} = {ab})::int::double", *addr, _indel(aa, ab), _ngram(aa, ab, 3), f"abs(length({aa}) - length({ab}))::double",
        f"case when len(a.numeric_tokens) = 0 and len(b.numeric_tokens) = 0 then 0.5 when len(a.numeric_tokens) = 0 or len(b.numeric_tokens) = 0 then 0.0 else {num} / least(len(list_distinct(a.numeric_tokens)), len(list_distinct(b.numeric_tokens))) end", f"{num}::double",
        f"case when {unknown} then 0.5 when a.norm_country = b.norm_country then 1.0 else 0.0 end::double", f"case when {unknown} or a.norm_country = b.norm_country then 0.0 else 1.0 end::double",
        f"({aa} = '')::int::double", f"({ab} = '')::int::double", "contains(b.source, '2')::int::double", "contains(b.source, '3')::int::double",
        "0.55 * name_lev + 0.35 * addr_lev + 0.10 * country_match", "least(name_lev, addr_lev)", "greatest(name_lev, addr_lev)", "2 * name_lev * addr_lev / (name_lev + addr_lev + 1e-6)",
    ]
    return dict(zip(FEATURES, values, strict=True))


_F = _feature_sql()
_LAST = ("composite_sim", "min_sim", "max_sim", "harmonic_sim")


def _features(*columns: str) -> str:
    below = [c for c in columns if c not in _LAST]
    below += [c for c in ("name_lev", "addr_lev", "country_match") if c not in below and any(x in _LAST for x in columns)]
    inner = ", ".join(f"({_F[c]})::double {c}" for c in below)
    outer = ", ".join(f"round({_F[c] if c in _LAST else c}, 6)::double {c}" for c in columns)
    return f"{KEYS} select s1_id, target_id, {outer} from (select c.s1_id, c.target_id, {inner} from c join s1 a on a.id = c.s1_id join t b on b.id = c.target_id)"


_COMPOSITE = f"(select s1_id, target_id, {_F['composite_sim']} composite_sim from (select c.s1_id, c.target_id, " + ", ".join(f"({_F[c]})::double {c}" for c in ("name_lev", "addr_lev", "country_match")) + " from c join s1 a on a.id = c.s1_id join t b on b.id = c.target_id))"
SCORED = f"""{KEYS}, sc as (select x.s1_id, x.target_id, (truth.s1_id is not null)::int as label, round(least(1 / (1 + exp(-10.0 * (composite_sim - 0.58))), 0.999), 6)::double prob from {_COMPOSITE} x left join truth using (s1_id, target_id)),
m as (select s1_id, target_id from sc where prob >= {THRESHOLD}), sp as (select id s1_id from s1),
o as (select sp.s1_id, count(y.s1_id) n_true, count(p.s1_id) n_pred, count(y.s1_id + 0) filter (where p.s1_id is not null) tp from sp left join (select s1_id, target_id from truth union select s1_id, target_id from m) u using (s1_id) left join truth y on y.s1_id = u.s1_id and y.target_id = u.target_id left join m p on p.s1_id = u.s1_id and p.target_id = u.target_id group by 1)""".replace("count(y.s1_id + 0)", "count(y.s1_id)")
_RATES = "case when tp + fp > 0 then tp / (tp + fp) else 0 end as precision, case when tp + fn > 0 then tp / (tp + fn) else 0 end as recall"
_FS = "round(precision, 6)::double as precision, round(recall, 6)::double as recall, round(case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end, 6)::double f1, round(case when precision + recall > 0 then 1.25 * precision * recall / (0.25 * precision + recall) else 0 end, 6)::double f05"
CURVE = f"{SCORED}, g as (select unnest(range(30, 96)) / 100 threshold), q as (select threshold, count(*) filter (where prob >= threshold and label = 1) tp, count(*) filter (where prob >= threshold and label = 0) fp, count(*) filter (where prob < threshold and label = 1) fn, count(*) filter (where prob < threshold and label = 0) tn from g, sc group by 1), v as (select round(threshold, 6)::double threshold, tp, fp, fn, tn, {_FS} from (select *, {_RATES} from q))"


def _lists(of: str, name: str) -> str:
    return f"select sp.s1_id source1_entity_id, '[' || coalesce(string_agg(distinct x.target_id, ', ' order by x.target_id), '') || ']' {name} from sp left join ({of}) x using (s1_id) group by 1"


def oracle_sql() -> dict[str, str]:
    n = RECORDS
    s = lambda x: f"array_to_string({x}, ' ') {x}"
    truth_text = f"tl as ({_lists('select s1_id, target_id from truth', 'matched_entity_ids')})"
    spined = f"{n}, sp as (select id s1_id from s1), {truth_text}"
    blocks = {"exact": "block_exact", "first": "block_first_token", "number": "block_numeric", "address": "block_address"}
    coded = KEYS.replace(BIZ.replace("{part}", "part"), CODED.replace("{part}", "part"), 1)
    return {
        "norm_name": f"{n} select id, norm_name, len(name_tokens)::bigint n_tokens from n",
        "norm_address": f"{n} select id, norm_address from n",
        "norm_country": f"{n} select id, norm_country from n",
        "numeric_tokens": f"{n} select id, {s('numeric_tokens')} from n",
        "missing_flags": f"{n} select id, (norm_name = '')::int missing_name, (norm_address = '')::int missing_address, (norm_country = '')::int missing_country from n",
        "preprocess": f"{n} select id, source, raw_name, raw_address, raw_country, norm_name, {s('name_tokens')}, norm_address, {s('addr_tokens')}, {s('numeric_tokens')}, norm_country from n",
        "entity_ids": f"{n} select distinct trim(id) id from n",
        "ground_truth_list": f"{n} select s1.id s1_id, target_id from s1 left join truth on truth.s1_id = s1.id",
        "ground_truth_pairs": f"{n} select s1_id, target_id from truth",
        "ground_truth_last": f"{n} select s1.id s1_id, target_id from s1 left join truth on truth.s1_id = s1.id",
        "last_records": f"{n} select id, norm_name, norm_address, norm_country from n",
        "input_counts": f"{n}, z as (select source as \"table\", count(*) as \"rows\" from n group by 1) select * from z union all select 'targets', count(*) from t union all select 'truth', count(distinct s1_id) from truth",
        **{name: f"{KEYS} select s1_id, target_id from kp where pass = '{p}'" for p, name in blocks.items()},
        **{name: f"{coded} select s1_id, target_id from kp where pass = '{p}'" for p, name in (("prefix", "block_prefix3"), ("token", "block_token"))},
        "pool_sizes": f"{KEYS} select pass, key, count(*) pool from kt group by all",
        "block_country_filter": f"{KEYS} select s1_id, target_id from c",
        "block_passes": f"{KEYS} select s1_id, target_id, string_agg(pass, ',' order by pass) passes from kp group by all",
        "block_tfidf_topk": f"{TFIDF} select s1_id, target_id, sim::double sim from nb",
        "block_union_cap": f"{TFIDF} select s1_id, target_id from (select *, row_number() over (partition by s1_id order by target_id) nth from (select s1_id, target_id from c union select s1_id, target_id from nb)) where nth <= 80",
        "candidate_recall": f"{KEYS} select count(*) true_pairs, count(c.s1_id) covered, round(count(c.s1_id) / greatest(count(*), 1), 6)::double candidate_recall from truth left join c using (s1_id, target_id)",
        "candidate_stats": f"{KEYS} select (select count(*) from s1) entities, count(*) pairs, round(count(*) / greatest((select count(*) from s1), 1), 6)::double mean_candidates from c",
        "feat_token_overlap": _features("name_exact", "name_token_exact", "name_jaccard", "name_overlap", "name_common_tokens", "addr_exact", "addr_jaccard", "addr_overlap", "addr_common_tokens"),
        "feat_ngram": _features("name_ngram2", "name_ngram3", "addr_ngram3"),
        "feat_indel": _features("name_lev", "addr_lev"),
        "feat_numeric": _features("num_overlap", "num_common_count"),
        "feat_country": _features("country_match", "country_conflict", "missing_s1_addr", "missing_c_addr", "is_source2", "is_source3"),
        "feat_length": _features("name_len_diff", "name_len_ratio", "addr_len_diff"),
        "composite_score": _features(*_LAST),
        "feat_all": _features(*FEATURES),
        "sigmoid_score": f"{SCORED} select s1_id, target_id, prob, label from sc",
        "label_attach": f"{KEYS} select c.s1_id, c.target_id, (truth.s1_id is not null)::int as label from c left join truth using (s1_id, target_id)",
        "pair_metrics": f"{CURVE} select * from v where threshold = {THRESHOLD}",
        "threshold_curve": f"{CURVE} select * from v",
        "best_threshold": f"{CURVE} select * from v order by f05 desc, threshold limit 1",
        "entity_metrics": f"""{SCORED}, x as (select count(*) total_s1, count(*) filter (where n_true = 0) true_singletons, count(*) filter (where n_true = 0 and n_pred = 0) correct_singletons, count(*) filter (where n_true = tp and n_pred = tp) exact, count(*) filter (where n_true > 1) multi_match_true,
  count(*) filter (where n_pred > 1) multi_match_pred, sum(tp)::bigint tp, sum(n_pred - tp)::bigint fp, sum(n_true - tp)::bigint fn from o)
  select total_s1, true_singletons, correct_singletons, round(case when true_singletons > 0 then correct_singletons / true_singletons else 1 end, 6)::double singleton_accuracy, round(exact / total_s1, 6)::double exact_entity_accuracy, multi_match_true, multi_match_pred, precision, recall, f05, tp, fp, fn, {THRESHOLD}::double threshold from (select * exclude (precision, recall), {_FS} from (select *, {_RATES} from x))""",
        "class_balance": f"{SCORED} select count(*) filter (where label = 1) positives, count(*) filter (where label = 0) negatives, round(least(greatest(count(*) filter (where label = 0) / greatest(count(*) filter (where label = 1), 1), 1), 5), 6)::double scale_pos from sc",
        "status_counts": f'{SCORED} select count(*) "all", sum(n_pred)::bigint total_matches, count(*) filter (where n_pred >= 1) matched, count(*) filter (where n_pred = 0) singletons, count(*) filter (where n_pred > 1) multi from o',
        "match_status": f"{SCORED} select s1_id, n_pred n_matches, case n_pred when 0 then 'singleton' when 1 then 'matched' else 'multi' end status from o",
        "matching_output": f"{SCORED} {_lists('select s1_id, target_id from m', 'matched_entity_ids')}",
        "candidate_output": f"{SCORED} {_lists('select s1_id, target_id from c union select s1_id, target_id from m', 'candidate_entity_ids')}",
        "results_view": f"{spined} select source1_entity_id, raw_name as name, raw_address address, raw_country country, replace(trim(matched_entity_ids, '[]'), ', ', ',') matches from tl join s1 on s1.id = source1_entity_id",
        "validate_violations": f"""{spined}, g as (select *, substr(source1_entity_id, 4, 8)::int k from tl), mm as (select case when k % 103 = 7 then 'X' || source1_entity_id else source1_entity_id end s, case when k % 97 = 3 then '[S2_00000000, S2_00000000]' else matched_entity_ids end ids from g where k % 101 <> 5 union all select source1_entity_id, matched_entity_ids from g where k % 107 = 9),
  cc as (select source1_entity_id s, case when k % 89 = 2 then '[]' else matched_entity_ids end ids from g), e as (select s, unnest(string_split(trim(ids, '[]'), ', ')) x from mm where ids <> '[]'), ce as (select distinct s, unnest(string_split(trim(ids, '[]'), ', ')) x from cc where ids <> '[]'), d as (select distinct s, x from e)
  select 'V4' "check", s id, 'repeated id' detail from mm group by s having count(*) > 1 union all select 'V5', s1_id, 'missing entity' from sp where s1_id not in (select s from mm) union all select distinct 'V5', s, 'unknown entity' from mm where s not in (select s1_id from sp)
  union all select 'V8', s, x from e group by s, x having count(*) > 1 union all select 'V9', s, 'unknown match ' || x from d where x not in (select id from t) union all select 'V9', s, 'no candidate ' || x from d anti join ce using (s, x)""",
        "validate_summary": f"{n}, z as (select s1.id, count(target_id) k from s1 left join truth on truth.s1_id = s1.id group by 1) select count(*) entities, sum(k)::bigint total_matches, count(*) filter (where k = 0) singletons, count(*) filter (where k > 1) multi_matches from z",
        "score_pair": f"{n}, c as (select s1_id, target_id from truth) select target_id id, round(composite_sim, 6)::double composite_sim, round(probability, 6)::double probability, {THRESHOLD}::double threshold, probability >= {THRESHOLD} is_match from (select *, least(1 / (1 + exp(-10.0 * (composite_sim - 0.58))), 0.999) probability from {_COMPOSITE})",
        "resolve": f"""{TFIDF}, f as (select s1_id, target_id from c union select s1_id, target_id from nb),
  m as (select s1_id, target_id from {_COMPOSITE.replace(" from c join s1 a on a.id = c.s1_id", " from f c join s1 a on a.id = c.s1_id")} where least(1 / (1 + exp(-10.0 * (composite_sim - 0.58))), 0.999) >= {THRESHOLD}), sp as (select id s1_id from s1) {_lists("select s1_id, target_id from m", "matched_entity_ids")}""",
    }
