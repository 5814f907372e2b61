"""Named queries of the training-data operators and their reference SQL."""

from __future__ import annotations

from ledgerpulse.llm.ball_search import op11_ball_tree_search
from ledgerpulse.llm.decontaminate import op7_benchmark_decontamination
from ledgerpulse.llm.fingerprints import op5_document_fingerprints
from ledgerpulse.llm.hmm import op6_lm_scoring
from ledgerpulse.llm.langid import op2_language_id
from ledgerpulse.llm.licenses import op3_license_scan
from ledgerpulse.llm.lexical_search import op13_ranked_lexical_search
from ledgerpulse.llm.line_dedup import op8_line_dedup
from ledgerpulse.llm.ngram_join import op1_ngram_jaccard_join
from ledgerpulse.llm.packing import op10_best_fit_packing
from ledgerpulse.llm.periodic_runs import op12_periodic_runs
from ledgerpulse.llm.quality import op9_quality_classifier
from ledgerpulse.llm.token_files import op4_token_files

QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_language_id, op3_license_scan, op4_token_files, op5_document_fingerprints, op6_lm_scoring,
    op7_benchmark_decontamination, op8_line_dedup, op9_quality_classifier, op10_best_fit_packing,
    op11_ball_tree_search, op12_periodic_runs, op13_ranked_lexical_search)}

_PLAIN_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

OP1 = r"""
with recursive docs as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
grams as (select distinct r, array_to_string(w[i:i + 4], ' ') as g
          from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from docs where len(w) > 0)),
sizes as (select r, count(*) as n from grams group by r),
shared as (select a.r as x, b.r as y, count(*) as o from grams a join grams b on a.g = b.g and a.r <> b.r group by a.r, b.r),
links as (select x, y from shared join sizes p on p.r = x join sizes q on q.r = y where 100 * o >= 80 * (p.n + q.n - o)),
reach(r, s) as (select r, r from docs union select reach.r, links.y from reach join links on links.x = reach.s)
select d.doc_id, coalesce(n, 0) as n_shingles, min(t.doc_id) as component_id
from docs d left join sizes using (r) join reach on reach.r = d.r join docs t on t.r = reach.s
group by d.r, d.doc_id, n
"""

OP7 = f"""
with docs as (select row_number() over () as r, doc_id, {_PLAIN_WORDS} as w from documents),
items as (select distinct item_id, {_PLAIN_WORDS} as w from benchmark where item_id is not null),
item_windows as (
  select item_id, least(13, len(w)) as n, w[i:i + least(13, len(w)) - 1] as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from items where len(w) > 0)),
sizes as (select distinct n from item_windows),
places as (
  select r, i, n, w[i:i + n - 1] as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, sizes where len(w) >= n)),
found as (select r, i, p.n, item_id from places p join item_windows v on p.n = v.n and p.win = v.win),
hit as (select r, count(distinct k) as n_hit from (select r, unnest(range(i, i + n)) as k from found) group by r),
named as (select r, count(*) as n_items, string_agg(x, ',' order by x) as names
          from (select distinct r, cast(item_id as varchar) as x from found) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hit using (r) left join named using (r)
"""

OP8 = r"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
lines as (select r, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from docs),
keyed as (select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
counted as (select key, count(distinct r) as n, max(doc_id) as keeper from keyed where length(key) >= 20 and doc_id is not null group by key),
marked as (select k.*, coalesce(c.n >= 3 and k.doc_id <> c.keeper, false) as gone from keyed k left join counted c on k.key = c.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by r, doc_id
"""

OP11 = """
with vectors as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.r, a.vec_id as query_id, b.r as row, b.vec_id, cast(list_dot_product(a.v, b.v) as bigint) as score
  from vectors a join vectors b on a.r <> b.r and len(a.v) = len(b.v) where a.vec_id % 50 = 0),
ranked as (select *, cast(row_number() over (partition by r order by score desc, vec_id nulls last, row) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

OP13 = r"""
with docs as (select row_number() over () as r, doc_id, list_transform(regexp_extract_all(coalesce(text, ''),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as w from documents),
items as (select row_number() over () as i, item_id, list_distinct(list_transform(regexp_extract_all(coalesce(text, ''),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) as w from benchmark),
totals as (select count(*) as n_docs, sum(len(w)) as n_all from docs where len(w) > 0),
asked as (select i, item_id, unnest(w) as term from items),
held as (select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(w) as n, unnest(w) as term from docs) group by all),
weights as (select term, cast(floor(1000 * ln(cast(2 * any_value(n_docs) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
            from held, totals where term in (select term from asked) group by term),
scored as (select i, item_id, r, doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + cast(90 * n * n_docs as bigint) // cast(n_all as bigint))))) as score
           from asked join weights w using (term) join held using (term), totals group by all),
ranked as (select *, cast(row_number() over (partition by i order by score desc, doc_id nulls last, r) as integer) as rank from scored where score > 0)
select item_id, rank, doc_id, cast(score as bigint) as score from ranked where rank <= 10
"""

ORACLES = {"op11_ball_tree_search": OP11, "op13_ranked_lexical_search": OP13, "op1_ngram_jaccard_join": OP1, "op7_benchmark_decontamination": OP7, "op8_line_dedup": OP8}
