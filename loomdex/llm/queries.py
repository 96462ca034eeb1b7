"""Registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.llm import (
    decontaminate, exact_dedup, html_text, langid, line_runs, merkle, packing, permutation_index, repeated_bytes, simhash, toxicity,
    url_filter, whitening,
)
from loomdex.llm.common import held_out, keep, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

URL_RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)
#: Hosts whose pages are on the list of unwanted URLs, besides those labelled toxic.
UNWANTED_HOST = "spam|pills|casino|malware|phish"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_spaced_seed_overlap(spark, sf):
    found = decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_windows", F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"))


def _mask_key(number: int, window: str, places: list[int]) -> str:
    return f"concat_ws(' ', '{number}', " + ", ".join(f"{window}[{i + 1}]" for i in places) + ")"


def _spaced_seed_sql() -> str:
    span, least = decontaminate.SPAN, decontaminate.LEAST_TOKENS
    keys = [_mask_key(m, "v", [i for i in range(span) if mask[i] == "1"]) for m, mask in enumerate(decontaminate.MASKS)]
    scripts = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in decontaminate.UNSPACED)
    tokens = rf"regexp_extract_all(regexp_replace(lower(text), '([{scripts}])', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')"
    return f"""
with d as (select doc_id, {tokens} as t from documents),
b as (select item_id, {tokens} as t from benchmark),
item_windows as (
  select distinct item_id, t[p + 1:p + {span}] as v, {span} as n from (select item_id, t, unnest(range(len(t) - {span} + 1)) as p from b)
  union select item_id, t, len(t) from b where len(t) between 1 and {span - 1}),
item_keys as (
  select item_id, n, v, unnest(case when n = {span} then [{", ".join(keys)}] else [concat_ws(' ', -n, array_to_string(v, ' '))] end) as key
  from item_windows),
doc_keys as (
  select doc_id, p, v, unnest([{", ".join(keys)}]) as key from (
    select doc_id, p, t[p + 1:p + {span}] as v from (select doc_id, t, unnest(range(len(t) - {span} + 1)) as p from d))
  union all select doc_id, p, v, concat_ws(' ', -len(v), array_to_string(v, ' ')) from (
    select doc_id, p, t[p + 1:p + n] as v from (
      select doc_id, t, n, unnest(range(len(t) - n + 1)) as p from d, (select distinct n from item_windows where n < {span}))
    where n >= {least} or n = len(t))),
hits as (
  select doc_id, p, item_id from doc_keys join item_keys i using (key)
  where list_sum(list_transform(range(1, n + 1), lambda x: (doc_keys.v[x] <> i.v[x])::int)) <= case when n = {span} then {decontaminate.MAX_SUBSTITUTIONS} else 0 end)
select doc_id, count(distinct p) as n_windows, array_to_string(list_sort(list(distinct item_id)), ',') as item_ids
from hits group by doc_id"""


ORACLE["op1_spaced_seed_overlap"] = _spaced_seed_sql()


@query
def op2_simhash_pigeonhole(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op3_permutation_index(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return permutation_index.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


@query
def op4_text_to_tag_ratio(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op5_cross_parsing_language(spark, sf):
    docs = table(spark, sf, "documents")
    judged = langid.identify(docs.select("doc_id", "text"), langid.learn(docs))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op6_counterfactual_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op7_bloom_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    listed = keep(_listed_urls(spark, sf).select(url_filter.canonical_url(F.col("listed")).alias("listed_url")))  # read three times
    return url_filter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _listed_urls(spark, sf):
    """(listed): a list of unwanted URLs as others spell them: of pages labelled toxic, and of hosts with a bad name."""
    toxic = table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("page_id"), F.lit(True).alias("toxic")).distinct()
    marked = table(spark, sf, "pages").select("page_id", "url").join(toxic, "page_id", "left")
    unwanted = marked.filter(F.col("toxic") | url_filter.host_of(F.col("url")).rlike(UNWANTED_HOST))
    key = url_filter.canonical_url(F.col("url"))
    mark = F.when(F.contains(key, F.lit("?")), "&utm_source=list").otherwise("/?utm_source=list")
    return unwanted.select(F.concat(F.lit("HTTP://WWW."), key, mark, F.lit("#listed")).alias("listed"))


_REST = "coalesce(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end, '')"
_HOST = rf"translate(regexp_extract({_REST}, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = rf"regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1, 's')"
_QUERY = rf"regexp_extract({_REST}, '^[^?#]*\?([^#]*)', 1, 's')"

ORACLE["op7_bloom_url_filter"] = rf"""
with parsed as (
  select page_id, {_HOST} as host, {_PATH} as path,
    array_to_string(list_sort(list_filter(string_split({_QUERY}, '&'),
      lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref)='))), '&') as args
  from pages
), keyed as (
  select *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
    || case when args = '' then '' else '?' || args end as key
  from parsed
), rules(rule_host, rule_path, says) as (
  values {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}
), fitting as (
  select k.*, r.rule_host || r.rule_path as rule, r.says,
    row_number() over (partition by page_id, host, path, key order by length(r.rule_host || r.rule_path) desc) as nth
  from keyed k left join rules r
    on (k.host = r.rule_host or k.host like '%.' || r.rule_host) and starts_with(k.path, r.rule_path)
)
select page_id, host, path, rule,
  coalesce(says, case when host <> '' and key in
    (select key from keyed where regexp_matches(host, '{UNWANTED_HOST}') or page_id in (select doc_id from labels where toxic = 1)) then 'block' else 'allow' end) as verdict
from fitting where nth = 1
"""


@query
def op8_repeated_line_runs(spark, sf):
    done = line_runs.remove_repeated_lines(table(spark, sf, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# Every run of at most min_words lines, looked up as text; longer ones are unions of these.
ORACLE["op8_repeated_line_runs"] = f"""
with l as (select doc_id, string_split(text, chr(10)) as ls from documents),
n as (
  select doc_id, ls, list_transform(ls, lambda x: trim(translate(x, chr(9) || chr(13) || chr(12) || chr(11), '    '), ' ')) as t from l),
w as (select *, list_transform(t, lambda x: greatest(1, len(list_filter(string_split(x, ' '), lambda y: y <> '')))) as words from n),
starts as (select doc_id, t, words, unnest(range(len(t))) as i from w),
runs as (select *, unnest(range(1, least({line_runs.MIN_WORDS}, len(t) - i) + 1)) as m from starts),
counted as (
  select doc_id, i, m, row_number() over (partition by m, array_to_string(t[i + 1:i + m], chr(10)) order by doc_id, i) as nth
  from runs where list_sum(words[i + 1:i + m]) >= {line_runs.MIN_WORDS}),
cut as (select distinct doc_id, unnest(range(i, i + m)) as i from counted where nth > 1),
kept as (
  select s.doc_id, string_agg(l.ls[s.i + 1], chr(10) order by s.i) filter (c.i is null) as text, count(c.i) as n_removed
  from starts s join l on s.doc_id = l.doc_id left join cut c on s.doc_id = c.doc_id and s.i = c.i group by s.doc_id)
select l.doc_id, len(ls) as n_lines, n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from l join kept on l.doc_id = kept.doc_id"""


@query
def op9_repeated_bytes(spark, sf):
    return repeated_bytes.remove_repeated(table(spark, sf, "documents"))


@query
def op10_best_fit_packing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return packing.pack(docs, word_bpe_path())


@query
def op11_qdwh_whitening(spark, sf):
    return whitening.whitened_rows(table(spark, sf, "embeddings"))


#: Columns of a leaf, and the share of documents whose leaf is falsified to see that their witness no longer holds.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FALSIFIED_ONE_IN = 7


@query
def op12_merkle_witnesses(spark, sf):
    docs = table(spark, sf, "documents")
    fields = {c: F.col(c) for c in LEAF_FIELDS}
    falsified = fields | {"n_chars": F.col("n_chars") + 1}
    chosen = F.crc32(F.col("doc_id").cast("string")) % FALSIFIED_ONE_IN == 0
    leaf = merkle.leaf_of(*fields.values())
    claimed = F.when(chosen & F.col("n_chars").isNotNull(), merkle.leaf_of(*falsified.values()))
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), claimed.alias("claimed"))
    done = merkle.manifest(leaves, "lang", "doc_id", carried=["doc_id", "claimed"])
    folded = merkle.folded(F.coalesce("claimed", "leaf"), F.col("witness"))
    return done.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("witness")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_LEAF_SQL = "sha256(" + " || ".join(
    f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in LEAF_FIELDS
) + ")"
# CRC-32 of the digits of a number: a byte at a time, a bit at a time.
_CRC_SQL = """xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
    lambda crc, b: list_reduce([0::bigint, 1, 2, 3, 4, 5, 6, 7],
      lambda r, k: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end, xor(crc, b)), 4294967295::bigint), 4294967295)"""


def _tree_sql(name: str, leaves: str) -> str:
    """Levels of all trees; then, for each leaf, its way up as steps."""
    return f"""
{name}_nodes(grp, level, i, n, h) as (
  select grp, 0, i, n, h from {leaves}
  union all
  select grp, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by i)) from {name}_nodes where n > 1 group by grp, level, i // 2),
{name}_steps as (
  select l.grp, l.i, list(case when s.h is null then '' when s.i % 2 = 0 then '<' || s.h else '>' || s.h end order by p.level) as steps
  from {leaves} l join {name}_nodes p on p.grp is not distinct from l.grp and p.n > 1 and p.i = l.i >> p.level
  left join {name}_nodes s on s.grp is not distinct from l.grp and s.level = p.level and s.i = xor(p.i, 1)
  group by l.grp, l.i)"""


ORACLE["op12_merkle_witnesses"] = f"""
with recursive claims as (
  select doc_id, lang, {_LEAF_SQL} as leaf,
    {_LEAF_SQL.replace("n_chars::varchar", f"(n_chars + ({_CRC_SQL} % {FALSIFIED_ONE_IN} = 0)::int)::varchar")} as claimed
  from documents),
leaves as (
  select doc_id, claimed, coalesce('=' || lang, '') as grp, leaf as h, count(*) over (partition by lang) as n,
    row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i
  from claims),
{_tree_sql("low", "leaves")},
tops as (
  select '' as grp, grp as of, h, count(*) over () as n, row_number() over (order by grp) - 1 as i from low_nodes where n = 1),
{_tree_sql("top", "tops")},
whole as (
  select doc_id, leaves.h as leaf, claimed, t.h as subroot, (select h from top_nodes where n = 1) as root,
    coalesce(l.steps, []) || coalesce(u.steps, []) as steps
  from leaves join tops t on t.of = leaves.grp
  left join low_steps l on l.grp = leaves.grp and l.i = leaves.i left join top_steps u on u.i = t.i),
done as (
  select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: substr(s, 2)), '')) as proof_sha256,
    list_reduce(steps, lambda node, s: sha256(case when s[1] = '<' then substr(s, 2) || node else node || substr(s, 2) end), claimed) as folded_root
  from whole)
select *, folded_root = root as verified from done"""


@query
def op13_exact_dedup(spark, sf):
    return exact_dedup.duplicates(table(spark, sf, "documents"))


ORACLE["op13_exact_dedup"] = r"""
with d as (select doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
ranked as (
  select *, row_number() over w as nth, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size
  from d window w as (partition by norm order by length(text) desc, doc_id nulls last))
select doc_id, keep_id, group_size, nth = 1 as kept, sha256(norm) as text_sha256 from ranked"""
