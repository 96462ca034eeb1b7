"""SQL twins of the registered queries, written for the checking engine (RE2 regular expressions).

They follow the definitions, not the Spark plans: token offsets by window sums, ranking by plain
joins, paragraphs and elements by regular expressions.
"""

from __future__ import annotations

from loomdex.functions import stemmer as st
from loomdex.functions import vocab
from loomdex.plans import inputs, queries

ORACLE: dict[str, str] = {}

WS = r"[\t-\r\x{85}\p{Z}]"
# The twins have patterns of their own, so that a fault in the engine's shows.
BAD_ESCAPE = r"%(?:$|[^0-9a-fA-F]|[0-9a-fA-F](?:$|[^0-9a-fA-F]))"
CONTROL = r"[[:cntrl:]]"
HOST_PORT = r"""^(?:\[[^][]*\]|[^][<> ":]*)(?::\d*)?$"""
MEDIA = r"[.](?:" + "|".join(vocab.MEDIA_EXTENSIONS) + r")(?:[?]|$)"
BLOCKS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
BLOCK_TAG = r"</?(?:" + "|".join(BLOCKS) + r")(?:\s[^>]*|/)?>"
# Words by code points: letters and marks outside the scripts written without blanks, numbers with inner
# commas, katakana runs, and every other letter of those scripts alone.
ALONE = "฀-໿က-႟ក-៿々-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
KANA = "ァ-ヺー-ヿㇰ-ㇿｦ-ﾟ"
SPELT = rf"(?:[^\P{{L}}{ALONE}]|[^\P{{M}}{ALONE}])"
SPELT_RUN = rf"{SPELT}(?:{SPELT}|[\x{{AD}}\x{{200C}}\x{{200D}}])*"
ALONE_LETTER = r"(?:" + "|".join(rf"[{r}]" for r in (
    "\u0e01-\u0e30\u0e32\u0e33\u0e40-\u0e46", "\u3005\u3006\u3031-\u3035\u303b\u303c", "\u3041-\u3096\u309d-\u309f", "\u3400-\u4dbf\u4e00-\u9fff",
    "\U00020000-\U0002a6df",
)) + ")"
TOKEN = (
    rf"(?:{SPELT_RUN}(?:['’‘.:·․‧﹒﹕＇．：]{SPELT_RUN})*|\p{{N}}+(?:[,;'’‘.․،٬﹐﹒﹔＇，．；]\p{{N}}+)*|\p{{Pc}}+)+"
    rf"|[{KANA}][{KANA}\x{{3099}}\x{{309A}}]*|{ALONE_LETTER}\p{{M}}*"
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def arr(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def inlist(items) -> str:
    return "(" + ", ".join(q(i) for i in items) + ")"


def pick(items, pos: str) -> str:
    return f"{arr(items)}[({pos}) % {len(items)} + 1]"


def fold(x: str) -> str:
    return f"lower(translate({x}, 'İΣ', 'iσ'))"


def trim(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{WS}+|{WS}+' + chr(92) + 'z')}, '', 'g')"


def rep(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def ext(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {q(WS + '+')}), lambda w: w <> '')"


def any_in(x: str, items) -> str:
    return "(" + " or ".join(f"contains({x}, {q(i)})" for i in items) + ")"


def cyr(x: str) -> str:
    return f"translate({x}, {q(inputs.LATIN)}, {q(inputs.CYRILLIC)})"


def not_query_stop(w: str) -> str:
    return f"{fold(w)} not in {inlist(vocab.QUERY_STOP)}"


def clean(x: str) -> str:
    kept = f"array_to_string(list_filter({words(x)}, lambda w: {not_query_stop('w')}), ' ')"
    return f"coalesce(nullif({kept}, ''), {x})"


def strip_ws(x: str) -> str:
    return trim(rep(x, r"[\t\n\f\r ]+", " "))


def escape(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def decode(x: str) -> str:
    for a, b in (("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
        x = rep(x, a, b)
    return x


def truncate(x: str, n: int = 250) -> str:
    return f"case when length({x}) > {n} then {escape(f'left({x}, {n})')} || '...' else {escape(x)} end"


def scrub(x: str) -> str:
    for p in vocab.WIKI_PATTERNS:
        x = rep(x, "(?i)" + p, " ")
    return x


# The checking engine counts edits in bytes; the accented letters of the tables become one byte each.
ACCENTED = "éèêçäöüßóíñÉÈÊÇÄÖÜÓÍÑ"
ONE_BYTE = "".join(f"chr({n}) || " for n in [*range(1, 9), *range(14, 27)])[:-4]


def edits(a: str, b: str) -> str:
    return f"levenshtein(translate({a}, {q(ACCENTED)}, {ONE_BYTE}), translate({b}, {q(ACCENTED)}, {ONE_BYTE}))"


# --- inputs --------------------------------------------------------------------------------

VARIANTS = (
    "variants as (select page_id, (unnest(range(len(v))))::bigint as variant, unnest(v) as url from "
    f"(select page_id, [{', '.join(inputs.URL_VARIANTS)}] as v from pages))"
)
HOST_IPS = (
    "host_names as (select distinct regexp_extract(url, '^https?://([^/?#:]*)', 1) as host from pages), "
    "octets as (select host, ('0x' || substr(md5(host), 3, 2))::int as a, ('0x' || substr(md5(host), 5, 2))::int as b, "
    "('0x' || substr(md5(host), 7, 2))::int as c, ('0x' || substr(md5(host), 9, 2))::int as d, "
    "substr(md5(host), 1, 1) in ('0', '1', '2', '3') as closed from host_names), "
    "host_ips as (select host, '93.184.' || a || '.' || b as ip, true as is_public from octets union all "
    "select host, case when closed then '10.' else '93.' end || '1.' || c || '.' || d, not closed from octets)"
)
KNOWN = (
    "known as (select url as doc_key from pages where page_id in (select doc_id from labels where quality = 1))"
)


def authority(u: str) -> str:
    return rep(ext(u, r"(?i)^https?://([^/?#]*)"), r"^.*@")


def parses(u: str) -> str:
    return (
        f"(not {has(u, CONTROL)} and not {has(rep(u, r'[?][^#]*'), BAD_ESCAPE)} and {has(authority(u), HOST_PORT)})"
    )


def valid(u: str) -> str:
    return f"({has(u, '(?i)^https?:')} and {parses(u)})"


def host(u: str) -> str:
    name = ext(authority(u), r"^(\[[^\[\]]*\]|[^:]*)")
    return f"lower(replace(replace({name}, '[', ''), ']', ''))"


def normal(u: str) -> str:
    plain = f"regexp_replace({trim(u)}, '#.*', '')"
    return (
        f"case when {has(plain, '(?i)^https?:')} then lower({ext(plain, '^([A-Za-z]+):')}) || {ext(plain, '^[A-Za-z]+(:.*)')} "
        f"else {plain} end"
    )


def allowed(h: str, entries) -> str:
    names = [e.strip().lower() for e in entries if e.strip()]
    return "(" + " or ".join(f"{h} = {q(n)} or ends_with({h}, {q('.' + n)})" for n in names) + ")"


ORACLE["url_valid"] = f"with {VARIANTS} select page_id, variant, {valid('url')} as valid from variants"
ORACLE["url_media"] = f"with {VARIANTS} select page_id, variant, {has('lower(url)', MEDIA)} as media from variants"
_decoded = f"case when {has('url', BAD_ESCAPE)} then url else url_decode(url) end"
ORACLE["url_service"] = (
    f"with {VARIANTS} select page_id, variant, {any_in('u', vocab.SERVICE_MARKS)} as service "
    f"from (select page_id, variant, {_decoded} as u from variants)"
)
ORACLE["url_normalize"] = f"with {VARIANTS} select page_id, variant, {normal('url')} as url from variants"
ORACLE["url_allowed_host"] = f"""
with {VARIANTS}, h as (select page_id, variant, {host('url')} as host from variants)
select page_id, variant, host,
  case when page_id % 2 = 0 then false else {allowed('host', ['example.net', 'localhost'])} end as restricted,
  case when page_id % 2 = 0 then true else {allowed('host', ['example.net'])} end as allowed
from h"""


def reason(u: str, allow: str) -> str:
    t = trim(u)
    return (
        f"case when not {parses(t)} then 'invalid URL' when not {has(t, '(?i)^https?:')} then 'unsupported scheme' "
        f"when h = '' then 'missing host' when h = 'localhost' or ends_with(h, '.localhost') then 'local host' "
        f"when not {allow} then 'host not allowed' when ok is null then 'host not resolved' "
        f"when not ok then 'non-public address' else '' end"
    )


SAFE_HOSTS = f"{HOST_IPS}, safe_hosts as (select host, bool_and(is_public) as ok from host_ips group by host)"
ORACLE["url_safe"] = f"""
with {VARIANTS}, {SAFE_HOSTS},
v as (select page_id, variant, url, {host(trim('url'))} as h from variants)
select page_id, variant, {reason('url', f"(page_id % 2 = 0 or {allowed('h', ['example.net'])})")} as reason
from v left join safe_hosts on h = host"""
_OPEN_V4 = "({0} not in (0, 10, 127) and {0} < 224)"
# What the ranges say about each address form of the inputs, in the same order.
IP_TRUTH = [
    _OPEN_V4.format("k % 256"), "k % 64 not between 16 and 31", "160 + k % 16 <> 168", "250 + k % 6 <> 254", "true",
    _OPEN_V4.format("k % 256"), "false", "false", "false", "true", "k % 3 = 2",
    _OPEN_V4.format("k % 400"), "false", "false", _OPEN_V4.format("k % 256"), "true", "true", "false", "k % 2 = 1",
    "false", "false", "false", "false",
]
assert len(IP_TRUTH) == len(inputs.IP_VARIANTS)
ORACLE["ip_public"] = f"""
select k as c_custkey, unnest([{', '.join(inputs.IP_VARIANTS)}]) as ip, unnest([{', '.join(IP_TRUTH)}]) as is_public
from (select c_custkey as k from customer)"""
ORACLE["sitemap_seed"] = f"""
with {VARIANTS} select page_id, variant, lower({ext('url', '^([A-Za-z]+):')}) || '://' || {ext('url', '^[A-Za-z]+://([^/?#]*)')} || '/sitemap.xml' as sitemap
from variants where {valid('url')} and {host('url')} <> ''"""
ORACLE["sitemap_locs"] = f"""
with {VARIANTS} select page_id, {decode('url')} as loc from variants where {valid(decode('url'))} and not {has('lower(url)', MEDIA)}"""
ORACLE["skip_indexed"] = f"with {KNOWN} select page_id, url from pages where url not in (select doc_key from known)"
ORACLE["is_url_indexed"] = f"with {KNOWN} select page_id, url from pages where url in (select doc_key from known)"
ORACLE["max_pages"] = f"select url, 1 + page_id % 4 as depth from pages order by depth, url limit {queries.PAGE_CAP}"
ORACLE["crawl_progress"] = f"select {host('url')} as host, count(*) as pages_found from pages group by 1"
ORACLE["crawl_status"] = f"""
with p as (select page_id, {host('url')} as host from pages),
second as (select host, count(*) filter (where page_id % 3 = 0) as n, bool_or(page_id % 120 = 0) as done from p
  where page_id % 4 = 1 or page_id % 3 = 0 group by host),
first as (select host, count(*) as n, bool_or(page_id % 50 = 1 or (page_id % 40 = 0 and page_id % 3 <> 0)) as done from p group by host),
newest as (select f.host, case when s.host is null then 1 else 2 end::bigint as crawl, case when s.host is null then f.n else s.n end as n,
  case when s.host is null then f.done else s.done end as done from first f left join second s on f.host = s.host)
select host, crawl, not done as running, n as pages_found,
  case when done then {q(vocab.CRAWL_FINISHED.split('%d')[0])} || n || {q(vocab.CRAWL_FINISHED.split('%d')[1])} else {q(vocab.CRAWL_STARTED)} end as message from newest"""

# --- configuration, stop words, upserts, uploads -------------------------------------------

_full = (
    "'{\"seed_urls\":[\"' || url || '\"],\"max_pages\":' || (page_id % 3) || ',\"max_depth\":' || (page_id % 4) || "
    "',\"allowed_hosts\":[\"example.net\"],\"user_agent\":\"' || case when page_id % 2 = 0 then '' else 'bot' end || "
    "'\",\"auto_start\":' || case when page_id % 3 = 0 then 'true' else 'false' end || '}'"
)
CONFIGS = (
    "configs as (select page_id, url, case when page_id % 13 = 0 then null when page_id % 7 = 0 then "
    f"replace({_full}, '}}', '') when page_id % 5 = 0 then '{{}}' else {_full} end as config from pages), "
    "cfg as (select *, config is not null and not json_valid(config) as broken, "
    "case when config is null or not json_valid(config) then '{}' else config end as j from configs)"
)


def cfg_number(name: str) -> str:
    d = vocab.CONFIG_DEFAULTS[name]
    return (
        f"case when broken then 0 else coalesce(nullif(cast(json_extract_string(j, '$.{name}') as bigint), 0), {d}) end::bigint as {name}"
    )


def cfg_list(name: str) -> str:
    return f"coalesce(array_to_string(cast(json_extract(j, '$.{name}') as varchar[]), ','), '') as {name}"


ORACLE["crawl_config"] = f"""
with {CONFIGS} select page_id, {cfg_list('seed_urls')}, {cfg_list('allowed_hosts')},
{', '.join(cfg_number(n) for n in ('max_pages', 'max_depth', 'delay_ms', 'parallelism'))},
case when broken then '' else coalesce(nullif(json_extract_string(j, '$.user_agent'), ''), {q(vocab.CONFIG_DEFAULTS['user_agent'])}) end as user_agent,
coalesce(cast(json_extract_string(j, '$.auto_start') as boolean), false) as auto_start
from cfg"""
ORACLE["safe_string"] = f"with {CONFIGS} select page_id, coalesce(config, '') as config from configs"
ORACLE["seed_list"] = f"""
with {CONFIGS}, s as (select page_id, case when page_id % 3 = 0 then [] else [{normal('url')}] end
  || coalesce(cast(json_extract(j, '$.seed_urls') as varchar[]), []) as seeds from cfg)
select page_id, unnest(range(len(seeds)))::bigint as ordinal, unnest(seeds) as seed from s"""
ORACLE["stopwords"] = f"select distinct {fold('w')} as word from (select unnest({words('text')}) as w from documents where doc_id % 5 <> 0)"
ORACLE["upsert_last_wins"] = (
    "select source as doc_key, max(doc_id) as seq, md5(arg_max(text, doc_id)) as content_hash from documents group by source"
)
_kind = "page_id % 9"
ORACLE["upload_validate"] = f"""
with f as (select page_id, {pick(["Doc.html", "Scan.PDF", "scan.pdf", "Old.HTM", "notes.txt", "a" + chr(9) + "b.html", ".htm", "plain", "x.pdf"], "page_id")} as name,
  case when {_kind} in (1, 2) then '%PDF-1.7' || chr(10) || html when page_id % 17 = 3 then ''
       when page_id % 19 = 5 then replace(html, '<', '(') else html end as body from pages),
g as (select *, '/in/' || page_id || '/' || name as path, lower({ext('name', r'([.][^.]*)$')}) as e,
  case when page_id % 11 = 0 then 20971520 when page_id % 11 = 1 then 20971521 else strlen(body) end as n, lower(body) as low from f)
select path,
  case when e not in ('.pdf', '.html', '.htm') then 'unsupported file type'
       when n < 1 or n > 20971520 then 'invalid file size'
       when e = '.pdf' and not starts_with(body, '%PDF-') then 'invalid PDF file'
       when e <> '.pdf' and not (contains(low, '<html') or contains(low, '<body') or contains(low, '<p')) then 'invalid HTML file'
       else '' end as error,
  case name when 'Doc.html' then 'Doc' when 'scan.pdf' then 'scan' when 'notes.txt' then 'notes' when 'x.pdf' then 'x'
       when '.htm' then 'document' when 'Scan.PDF' then 'Scan.PDF' when 'Old.HTM' then 'Old.HTM' when 'plain' then 'plain' else 'a b' end as title,
  case e when '.htm' then 'html' when '' then 'txt' else substr(e, 2) end as file_type,
  '/files/' || sha256(body) || e as file_path
from g"""
ORACLE["upload_files"] = f"""
with f as (select page_id, {pick(inputs.FILE_NAMES, "page_id")} as name,
  case when page_id % 17 = 3 then '' when page_id % 9 in (1, 2) then '%PDF-1.7' || chr(10) || html else html end as body from pages),
g as (select *, '/' || page_id || '/' || name as path, lower({ext('name', r'([.][^.]*)$')}) as e, lower(body) as low from f),
h as (select path, body, case when starts_with(name, '.') then 'hidden file name' when e not in ('.pdf', '.html', '.htm') then 'unsupported file type' when body = '' then 'invalid file size'
       when e = '.pdf' and not starts_with(body, '%PDF-') then 'invalid PDF file'
       when e <> '.pdf' and not (contains(low, '<html') or contains(low, '<body') or contains(low, '<p')) then 'invalid HTML file'
       else '' end as error,
  case when name = '.htm' then 'document' when e <> '' and ends_with(name, e) then {ext('name', r'^(.*)[.][^.]*$')} else name end as title,
  case e when '.htm' then 'html' when '' then 'txt' else substr(e, 2) end as file_type,
  case when not starts_with(name, '.') then '/files/' || sha256(body) || e end as file_path from g)
select path, error, title, file_type, file_path,
  case when count(*) filter (where error = '') over w > 0 then sha256(body) end as copy_sha256,
  nullif(count(*) filter (where error = '') over w, 0) as documents
from h window w as (partition by file_path)"""

# --- HTML ----------------------------------------------------------------------------------

HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def strip_html(h: str) -> str:
    h = rep(h, HIDDEN)
    for tag in vocab.DROPPED_TAGS:
        h = rep(h, rf"(?is)<{tag}\b.*?(?:</{tag}\s*>|\z)")
    return rep(h, r"""(?is)<div class=(?:"ad sidebar"|'menu'|reference)>.*?(?:</div\s*>|\z)""")


def page_text(source: str, out: str, key: str = "page_id") -> str:
    """CTEs from `source(key, stripped)` to `out(key, paragraphs, content)`."""
    para = trim(decode(rep(ext("piece", rf"(?is)^(.*?)(?:{BLOCK_TAG}|\z)"), r"<[^>]*>")))
    body = decode(rep(ext("stripped", r"(?is)<body[^>]*>(.*)"), r"<[^>]*>"))
    inner = rep(ext("stripped", r"(?is)<body[^>]*>(.*)"), r"[\t\n\f\r ]+", " ")
    by_block = f"string_split({rep(inner, '(?i)' + BLOCK_TAG, chr(10))}, chr(10))"
    one = strip_ws(decode(rep("b", "<[^>]*>")))
    body_lines = f"array_to_string(list_filter(list_transform({by_block}, lambda b: {one}), lambda b: b <> ''), chr(10))"
    return f"""
{out}_p as (select {key}, i, {para} as t from (
  select {key}, unnest(p) as piece, generate_subscripts(p, 1) as i from (
    select {key}, string_split_regex(stripped, '(?i)<p(?:\\s[^>]*)?>') as p from {source})) where i > 1),
{out}_j as (select {key}, string_agg(t || ' ', '' order by i) as t, string_agg({strip_ws('t')}, chr(10) order by i) as lines
  from {out}_p where t <> '' group by {key}),
{out} as (select s.{key}, coalesce(t, '') as paragraphs,
  case when strlen(coalesce(t, '')) < {vocab.MIN_PARAGRAPH_BYTES} then {body_lines} else lines end as lines,
  {strip_ws(scrub(f"case when strlen(coalesce(t, '')) < {vocab.MIN_PARAGRAPH_BYTES} then {body} else t end"))} as content
  from {source} s left join {out}_j j on s.{key} = j.{key})"""


CLASSED = f"""classed as (select page_id, replace(html, '<div class="ad">', {pick(inputs.CLASS_VARIANTS, 'page_id')}) as html from pages),
stripped as (select page_id, {strip_html('html')} as stripped from classed)"""
ORACLE["html_strip"] = f"with {CLASSED} select page_id, stripped as html from stripped"
ORACLE["html_paragraphs"] = f"with {CLASSED}, {page_text('stripped', 'pt')} select page_id, paragraphs as content from pt"
ORACLE["html_to_text"] = f"with {CLASSED}, {page_text('stripped', 'pt')} select page_id, content from pt"
TITLE = strip_ws(decode(ext("html", r"(?is)<title[^>]*>(.*?)</title")))
ORACLE["html_title"] = f"select page_id, {TITLE} as title from pages"


def boilerplate_steps(source: str, key: str, out: str) -> str:
    """CTE chain from `source(key, t)` to `out(key, t)`, one step per prefix."""
    steps, last = [], source
    for n, p in enumerate(vocab.BOILERPLATE_PREFIXES):
        tail = f"substr(t, instr(t, {q(p)}))"
        cut = (
            f"case when contains({tail}, chr(10)) then substr({tail}, instr({tail}, chr(10))) "
            f"when contains({tail}, '. ') then substr({tail}, instr({tail}, '. ')) else substr({tail}, {len(p) + 1}) end"
        )
        near = f"contains(t, {q(p)}) and strlen(left(t, instr(t, {q(p)}) - 1)) < 100"
        steps.append(f"{out}{n} as (select {key}, case when {near} then {trim(cut)} else t end as t from {last})")
        last = f"{out}{n}"
    steps.append(f"{out} as (select {key}, {trim('t')} as t from {last})")
    return ", ".join(steps)


def ingest_sql(source: str, known: str) -> str:
    return f"""
strp as (select url, {strip_html('html')} as stripped from {source}),
{page_text('strp', 'pt', 'url')},
raw as (select url, lines as t from pt),
{boilerplate_steps('raw', 'url', 'bp')},
done as (select s.url, {TITLE} as title, {rep('b.t', chr(92) + 'p{Mn}')} as content from {source} s join bp b on s.url = b.url
  where not {any_in('url_decode(s.url)', vocab.SERVICE_MARKS)} {known})
select url, title, content, md5(content) as content_hash"""


_lead = pick([p + t for p in vocab.BOILERPLATE_PREFIXES + ["Intro"] for t in (" — x. ", " y ")], "page_id")
_suffix = pick(["", "", "&action=history", "", "?oldid=7"], "page_id")
ORACLE["ingest_pages"] = f"""
with {KNOWN}, site as (select page_id, url || {_suffix} as url,
  replace(replace(html, '<p><b>', '<p><b>' || {_lead}), 'é', 'é') as html from pages),
{ingest_sql('site', 'and s.url not in (select doc_key from known)')}, 'web' as file_type
from done where strlen(content) >= {vocab.MIN_PAGE_BYTES}"""
ORACLE["stream_ingest"] = (
    f"with {ingest_sql('pages', '')} from done where strlen(content) >= {vocab.MIN_PAGE_BYTES}"
)

# --- links ---------------------------------------------------------------------------------


def links_sql(source: str) -> str:
    attribute = r"""(?is)[\s"']href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
    value = decode(rep(ext("a", attribute), r"^[\"']|[\"']$"))
    path = "regexp_extract(u, '^https?://[^/?#]*([^?#]*)', 1)"
    site = "regexp_extract(u, '^(https?://[^/?#]*)', 1)"
    query = "regexp_extract(u, '^[^?]*([?].*)', 1)"
    folded = path
    for pattern, by in ((r"/(?:\./)+", "/"), (r"/[^/]+/\.\./", "/"), (r"^(?:/\.\.)+/", "/")):
        folded = rep(folded, pattern, by)
    return f"""
anchors as (select url, unnest(x) as a, generate_subscripts(x, 1) - 1 as ordinal from (
  select url, regexp_extract_all({rep('html', HIDDEN)}, '(?is)<a\\s[^>]*>') as x from {source})),
refs as (select url, ordinal, {value} as href, regexp_extract(url, '^(https?://[^/?#]*)', 1) as site,
  regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) as base_path from anchors),
joined as (select url, ordinal, href, case when starts_with(href, '#') then ''
  when regexp_matches(href, '^[a-z]+:') then href
  when starts_with(href, '//') then regexp_extract(url, '^(https?:)', 1) || href
  when starts_with(href, '/') then site || href
  when starts_with(href, '?') then site || base_path || href
  else site || regexp_extract(base_path, '^(.*/)', 1) || href end as u from refs),
links as (select url, ordinal::bigint as ordinal,
  case when u = '' then '' else {site} || {folded} || {query} end as link from joined)"""


_closed = pick(['"', '"', "'", "", '"', '"', '"'], "page_id")
LINKED = f"""linked as (select page_id, url, regexp_replace(html, 'href="/([^"]*)"',
  {pick(inputs.HREF_VARIANTS, 'page_id')} || '\\1' || {_closed}, 'g') as html from pages)"""
ORACLE["link_extract"] = f"with {LINKED}, {links_sql('linked')} select url, ordinal, link from links"
ORACLE["link_filter"] = f"""
with {LINKED}, {links_sql('linked')}, {SAFE_HOSTS},
d as (select distinct url as src, link as dst, {host('link')} as h from links where {valid('link')} and not {has('lower(link)', MEDIA)})
select src, dst from d join safe_hosts on h = host where ok and {allowed('h', ['example.net', 'example.com'])}"""
ORACLE["crawl_frontier"] = f"with {links_sql('pages')} select distinct link as url from links where link not in (select url from pages)"
_levels = ", ".join(
    f"l{d} as (select distinct dst as url from edges where src in (select url from l{d - 1}) and dst not in (select url from v{d - 1})), "
    f"v{d} as (select url from v{d - 1} union all select url from l{d})"
    for d in range(2, queries.CRAWL_DEPTH + 1)
)
ORACLE["crawl_bfs"] = f"""
with edges as (select 'p' || page_id as src, 'p' || ((page_id * i + 7 * i * i + 1) % (select count(*) from pages)) as dst
  from pages, range(1, 7) r(i)),
l1 as (select 'p' || page_id as url from pages where 'p' || page_id in {inlist(queries.SEEDS)}), v1 as (select url from l1), {_levels}
{' union all '.join(f'select url, {d}::bigint as depth from l{d}' for d in range(1, queries.CRAWL_DEPTH + 1))}"""



def _site_url(number: str) -> str:
    return f"'http://s' || ({number}) % 5 || '.example.org/p' || ({number})"


_next = " || ".join(f"""'<a href="' || {_site_url(f"(page_id * {i} + {7 * i * i + 1}) % (select count(*) from pages)")} || '">next</a>'""" for i in (1, 2, 3))
SITE = f"""site as (select page_id, {_site_url('page_id')} as url, replace(html, '<article>', '<p>' || {_next} || '</p><article>') as html from pages),
{links_sql('site')},
edges as (select distinct url as src, link as dst from links where {valid('link')} and not {has('lower(link)', MEDIA)} and {host('link')} in (
  select distinct regexp_extract(url, '^http://([^/]*)', 1) from site where not starts_with(url, 'http://s4.'))),
l1 as (select url from site where page_id in (1, 2, 3)), v1 as (select url from l1), {_levels},
reached as ({' union all '.join(f'select url, {d}::bigint as depth from l{d}' for d in range(1, queries.CRAWL_DEPTH + 1))})"""
ORACLE["crawl_pages"] = f"with {SITE} select url, depth from reached"
# Pages are cleaned as they are visited; the cap counts those that are kept, level by level and by URL.
ORACLE["crawl_ingest"] = f"""
with {SITE}, found as (select site.url, html, depth from site join reached on site.url = reached.url),
{ingest_sql('found', '')}, depth from done join reached using (url) where strlen(content) >= {vocab.MIN_PAGE_BYTES}
order by depth, url limit {queries.PAGE_CAP}"""
# Entries: the two usable seeds, and every page that the maps of the hosts s0 and s1 name; s2 has no map, s3 is not allowed, s4 private.
_open = "regexp_matches(link, '^http://s[012][.]example[.]org/')"
ORACLE["crawl_seeded"] = f"""
with {SITE}, entries as (
  select url from site where url in ('http://s1.example.org/p1', 'http://s2.example.org/p2', 'http://s1.example.org/p6')
    or page_id % 16 = 0 and regexp_matches(url, '^http://s[01][.]')),
seeded as (select url, 1::bigint as depth from entries union all
  select distinct link, 2 from links where url in (select url from entries) and link in (select url from site)
    and {_open} and not {has('lower(link)', MEDIA)} and link not in (select url from entries)),
found as (select site.url, html from site join seeded on site.url = seeded.url),
{ingest_sql('found', '').rpartition('select url, title')[0].rstrip()}
select url, depth, url in (select url from done where strlen(content) >= {vocab.MIN_PAGE_BYTES}
  and url not in (select url from site where page_id in (select doc_id from labels where quality = 1))) as kept from seeded"""

# --- text ----------------------------------------------------------------------------------

ORACLE["wiki_scrub"] = (
    f"select doc_id, {scrub('t')} as content from (select doc_id, replace(text, chr(10), {pick(inputs.REMNANTS, 'doc_id')}) as t from documents)"
)
ORACLE["normalize_ws"] = (
    f"select doc_id, {strip_ws('t')} as content, trim({rep('t', WS + '+', ' ')}) as joined "
    f"from (select doc_id, replace(text, '. ', '.' || chr(9) || '  ') as t from documents)"
)
ORACLE["strip_boilerplate"] = f"""
with raw as (select doc_id, repeat('я', (doc_id % 60)::int) || {pick(vocab.BOILERPLATE_PREFIXES + ['none'], 'doc_id')} || ' x' || {pick(inputs.TAILS, 'doc_id')} || text as t from documents),
{boilerplate_steps('raw', 'doc_id', 'bp')} select doc_id, t as content from bp"""
ORACLE["strip_combining"] = "select doc_id, text as content from documents"
ORACLE["content_hash"] = "select doc_id, md5(text) as content_hash from documents"
ORACLE["min_bytes"] = f"select doc_id, strlen(text) as n_bytes from documents where strlen(text) >= {vocab.MIN_PAGE_BYTES}"
ORACLE["boilerplate_line"] = f"""
with l as (select doc_id, unnest(range(len(x)))::bigint as line_no, unnest(x) as line from (select doc_id, string_split(text, chr(10)) as x from documents))
select doc_id, line_no, {any_in(f"lower(line || ' ' || {pick([''] * 5 + [p.upper() for p in vocab.BOILERPLATE_PHRASES], 'doc_id + line_no')})", vocab.BOILERPLATE_PHRASES)} as boilerplate from l"""
ORACLE["html_escape"] = f"select page_id, {escape('html')} as escaped from pages"
ORACLE["snippet_truncate"] = f"select page_id, {truncate('html')} as snippet from pages"

# --- analysis ------------------------------------------------------------------------------


def spans_sql(source: str, key: str, text: str, out: str, size: str = "strlen", pattern: str = TOKEN) -> str:
    """CTEs giving out(key, pos, s, e, piece) of every match; offsets by window sums."""
    return f"""
{out}_u as (select {key}, unnest(p) as piece, generate_subscripts(p, 1) as i from (select {key},
  string_split(regexp_replace(replace({text}, chr(1), ' '), {q(pattern)}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) as p from {source})),
{out} as (select {key}, (i // 2)::bigint as pos, (e - {size}(piece))::bigint as s, e::bigint as e, piece from (
  select *, sum({size}(piece)) over (partition by {key} order by i) as e from {out}_u) where i % 2 = 0)"""


_V, _C = "[аеиоуыэюя]", "[^аеиоуыэюя]"
_RV = f"{_C}*{_V}.*?"


def stems_sql(source: str, out: str = "stems") -> str:
    """CTEs giving out(token, stem) for source(token), with the region rules written as prefixes."""
    gerund = rf"^(?:({_C}*{_V}.*?[ая])(?:{st._GERUND_AFTER_A})|({_RV})(?:{st._GERUND}))$"
    adjectival = (
        rf"^(?:({_C}*{_V}.*?[ая])(?:{st._PARTICIPLE_AFTER_A})(?:{st._ADJECTIVE})|({_RV})(?:{st._PARTICIPLE})(?:{st._ADJECTIVE})"
        rf"|({_RV})(?:{st._ADJECTIVE}))$"
    )
    verb = rf"^(?:({_C}*{_V}.*?[ая])(?:{st._VERB_AFTER_A})|({_RV})(?:{st._VERB}))$"

    def r(x: str, pattern: str, by: str = r"\1") -> str:
        return f"regexp_replace({x}, {q(pattern)}, {q(by)})"

    return f"""
{out}_a as (select token, replace(token, 'ё', 'е') as w from {source} where regexp_matches(token, '[а-яё]')),
{out}_b as (select token, {has('w', gerund)} as g, case when {has('w', gerund)} then {r('w', gerund, chr(92) + '1' + chr(92) + '2')}
  else {r('w', f'^({_RV})(?:ся|сь)$')} end as w from {out}_a),
{out}_c as (select token, case when g then w when {has('w', adjectival)} then {r('w', adjectival, chr(92) + '1' + chr(92) + '2' + chr(92) + '3')}
  when {has('w', verb)} then {r('w', verb, chr(92) + '1' + chr(92) + '2')} else {r('w', rf'^({_RV})(?:{st._NOUN})$')} end as w from {out}_b),
{out}_d as (select token, {r(r('w', f'^({_RV})и$'), f'^({_C}*{_V}+{_C}{_C}*{_V}+{_C}.*?)(?:ость|ост)$')} as w from {out}_c),
{out} as (select token, case when ends_with(w, 'ь') then {r('w', f'^({_RV})ь$')} else {r(r('w', f'^({_RV})(?:ейше|ейш)$'), f'^({_RV}н)н$')} end as stem from {out}_d
  union all select token, token from {source} where not regexp_matches(token, '[а-яё]'))"""


def mixed_scripts() -> str:
    return f"translate(text, {q(inputs.SMALL_LATIN)}, {q(inputs.MIXED)}) || ' ' || doc_id || ',' || strlen(text) || ';5.x 12:30 v1.2 ' || source"


def token_rows(source: str, key: str, text: str) -> str:
    return f"select {key}, unnest(regexp_extract_all({fold(text)}, {q(TOKEN)})) as token from {source}"


ORACLE["tokenize"] = f"""
with {spans_sql('documents', 'doc_id', 'text', 'sp')} select doc_id, pos, s as start, e as "end", {fold('piece')} as token from sp"""
ORACLE["word_rules"] = f"""
with mixed as (select doc_id, {mixed_scripts()} as text from documents), {spans_sql('mixed', 'doc_id', 'text', 'sp')}
select doc_id, pos, s as start, e as "end", {fold('piece')} as token from sp"""
ORACLE["stop_filter"] = f"""
select doc_id, array_to_string(list_filter({words(cyr('text'))}, lambda w: {not_query_stop('w')}), ' ') as cyrillic,
  array_to_string(list_filter({words('text')}, lambda w: {not_query_stop('w')}), ' ') as latin from documents"""
CYR_VOCABULARY = f"voc as (select distinct token from ({token_rows('documents', 'doc_id', cyr('text'))}))"
ORACLE["stem_ru"] = f"with {CYR_VOCABULARY}, {stems_sql('voc')} select token, stem from stems"
ORACLE["analyze"] = f"""
with {CYR_VOCABULARY}, {stems_sql('voc')},
t as (select doc_id, unnest(x) as token, generate_subscripts(x, 1) as i from (select doc_id, regexp_extract_all({fold(cyr('text'))}, {q(TOKEN)}) as x from documents)),
j as (select doc_id, string_agg(stem, ' ' order by i) as terms from t join stems using (token) where token not in {inlist(vocab.RUSSIAN_STOP)} group by doc_id)
select d.doc_id, coalesce(terms, '') as terms from documents d left join j on d.doc_id = j.doc_id"""


def corpus(cyrillic: bool = False) -> str:
    text = cyr("text") if cyrillic else "text"
    return (
        "corpus as (select 'https://docs.example.org/' || source || '/' || doc_id as doc_key, "
        f"split_part(t, chr(10), 1) as title, t as content from (select doc_id, source, {text} as t from documents))"
    )


BOTH_FIELDS = (
    "fields as (select doc_key, 'title' as field, title as t from corpus union all select doc_key, 'content', content from corpus)"
)


def postings_sql(source: str = "fields") -> str:
    return f"""
tk as (select doc_key, field, unnest(regexp_extract_all({fold('t')}, {q(TOKEN)})) as token from {source}),
voc as (select distinct token from tk where token not in {inlist(vocab.RUSSIAN_STOP)}), {stems_sql('voc')},
post as (select doc_key, field, stem as term, count(*) as tf from tk join stems using (token) group by all),
lens as (select doc_key, field, sum(tf)::bigint as n_tokens from post group by all),
df as (select field, term, count(*) as df from post group by all)"""


ORACLE["postings"] = f"""
with {corpus()}, {BOTH_FIELDS}, {spans_sql('fields', 'doc_key, field', 't', 'sp')},
occ as (select *, {fold('piece')} as token from sp), voc as (select distinct token from occ), {stems_sql('voc')}
select doc_key, field, stem as term, count(*) as tf, string_agg(pos || ':' || s || ':' || e, ',' order by pos) as locs
from occ join stems using (token) where token not in {inlist(vocab.RUSSIAN_STOP)} group by all"""
ORACLE["doc_freq"] = f"with {corpus(True)}, {BOTH_FIELDS}, {postings_sql()} select field, term, df from df"
ORACLE["field_len"] = f"""
with {corpus()}, {BOTH_FIELDS} select doc_key, field,
  len(list_filter(regexp_extract_all({fold('t')}, {q(TOKEN)}), lambda w: w not in {inlist(vocab.RUSSIAN_STOP)}))::bigint as n_tokens from fields"""
ORACLE["doc_count"] = "select count(distinct source) as n_docs from documents"
ORACLE["stats"] = 'select count(*) as "indexedPages" from documents'

# --- search --------------------------------------------------------------------------------

ASKED = "asked as (select item_id as query_id, text as q, 1::bigint as page, 10::bigint as size from benchmark)"
ASKED_CYR = f"asked as (select item_id as query_id, {cyr('text')} as q, 1::bigint as page, 10::bigint as size from benchmark)"
_page = f"try_cast({pick(['1', '2', '0', '-1', 'x', '900'], 'item_id')} as bigint)"
_size = f"try_cast({pick(['10', '50', '51', '0', '7', ''], 'item_id')} as bigint)"
PAGE = f"case when {_page} > 0 then {_page} else 1 end"
SIZE = f"case when {_size} between 1 and 50 then {_size} else 10 end"
REQUESTS = f"asked as (select item_id as query_id, text as q, {PAGE} as page, {SIZE} as size from benchmark)"
ORACLE["query_clean"] = f"with {ASKED} select query_id, {clean('q')} as cleaned from asked"
ORACLE["page_params"] = f"with {REQUESTS} select query_id, page, size from asked"


def weights_sql(fields: list[str]) -> str:
    """From qterms(query_id, term, reps, n_terms) to field and document scores."""
    return f"""
wt as (select query_id, field, x.term, reps, n_terms, 1 + ln((select count(*) from corpus) / (coalesce(df, 0) + 1.0)) as idf
  from (select * from qterms, (select unnest({arr(fields)}) as field)) x left join df using (field, term)),
nm as (select query_id, 1 / sqrt(sum(reps * idf * idf)) as nrm from wt group by query_id),
fs as (select query_id, doc_key, field, sum(reps)::bigint as matched,
    sum(reps * sqrt(tf) / sqrt(n_tokens) * idf * idf * nrm) * sum(reps) / any_value(n_terms) as score
  from wt join nm using (query_id) join post using (field, term) join lens using (doc_key, field) group by all),
scored as (select query_id, doc_key, round(sum(score) * count(*) / {len(fields)}, 9) as score from fs group by all)"""


def search_sql(cyrillic: bool = False, asked: str | None = None) -> str:
    asked = asked or (ASKED_CYR if cyrillic else ASKED)
    return f"""{corpus(cyrillic)}, {BOTH_FIELDS}, {asked}, {postings_sql()},
cleaned as (select query_id, {clean('q')} as cleaned from asked where q <> ''),
qt as (select query_id, unnest(regexp_extract_all({fold('cleaned')}, {q(TOKEN)})) as token from cleaned),
qvoc as (select distinct token from qt), {stems_sql('qvoc', 'qstems')},
qkept as (select query_id, stem as term from qt join qstems using (token) where token not in {inlist(vocab.RUSSIAN_STOP)}),
qterms as (select query_id, term, count(*) as reps, sum(count(*)) over (partition by query_id) as n_terms from qkept group by query_id, term),
{weights_sql(['title', 'content'])}"""


TOTALS = "totals as (select query_id, count(*) as total, max(score) as max_score from scored group by query_id)"
PAGES = (
    "ranks as (select *, row_number() over (partition by query_id order by score desc, doc_key) as rank from scored), "
    "page_hits as (select query_id, doc_key, score, rank, page, size from ranks join asked using (query_id) "
    "where rank > (page - 1) * size and rank <= page * size)"
)
TIER = "case when max_score = 0 then 'low' when score / max_score >= 0.7 then 'high' when score / max_score >= 0.4 then 'medium' else 'low' end"
for _field in ("content", "title"):
    ORACLE[f"match_{_field}"] = f"with {search_sql()} select query_id, doc_key, matched from fs where field = '{_field}'"
ORACLE["tfidf_score"] = f"with {search_sql()} select query_id, doc_key, field, round(score, 6) as score from fs"
ORACLE["should_combine"] = f"with {search_sql(True)} select query_id, doc_key, round(score, 6) as score from scored"
ORACLE["relevance_tier"] = f"with {search_sql()}, {TOTALS} select query_id, doc_key, {TIER} as relevance from scored join totals using (query_id)"
ORACLE["hit_total"] = f"with {search_sql()}, {TOTALS} select query_id, total, ((total + 9) // 10)::bigint as total_pages from totals"
ORACLE["search_page"] = f"""
with {search_sql()}, {PAGES} select query_id, rank, doc_key as url, title, round(score, 6) as score from page_hits join corpus using (doc_key)"""
ORACLE["index_update"] = ORACLE["search_page"]
ORACLE["batch_search"] = f"""
with {search_sql(asked=REQUESTS)}, {PAGES} select query_id, page, size, rank, doc_key, round(score, 6) as score from page_hits"""
DEDUPE = (
    f"keyed as (select query_id, rank, doc_key, score, title, {fold(trim('title'))} as title_key from page_hits join corpus using (doc_key)), "
    "kept as (select * from keyed qualify row_number() over (partition by query_id, title_key order by rank) = 1)"
)
ORACLE["title_dedupe"] = f"with {search_sql(asked=REQUESTS)}, {PAGES}, {DEDUPE} select query_id, rank, title_key from kept"

# --- suggestions ---------------------------------------------------------------------------

MISSPELT = (
    f"asked as (select item_id as query_id, regexp_replace(text, {q(inputs.MISSPELL_PATTERN)}, '\\1\\2', 'g') as q, "
    "1::bigint as page, 10::bigint as size from benchmark)"
)


def meaningful(x: str) -> str:
    return f"list_filter(list_transform({words(x)}, lambda w: {fold('w')}), lambda w: w not in {inlist(vocab.QUERY_STOP)} and length(w) > 2)"


def suggest_sql(asked: str) -> str:
    """CTEs from asked(query_id, q) and corpus to top (three documents) and fixes."""
    return f"""
one_field as (select doc_key, 'all' as field, title || chr(10) || content as t from corpus), {postings_sql('one_field')},
mw as (select query_id, {meaningful('q')} as ws from {asked}),
qtok as (select query_id, unnest(regexp_extract_all({fold("array_to_string(ws, ' ')")}, {q(TOKEN)})) as token from mw),
qvoc as (select distinct token from qtok where token not in {inlist(vocab.RUSSIAN_STOP)}), {stems_sql('qvoc', 'qstems')},
known_terms as (select distinct term from post),
near as (select a.term, b.term as sim from (select distinct stem as term from qstems) a join known_terms b
  on length(b.term) between length(a.term) - 2 and length(a.term) + 2 where {edits('a.term', 'b.term')} <= 2),
qexp as (select query_id, sim as term from qtok join qstems using (token) join near on stem = near.term),
qterms as (select query_id, term, count(*) as reps, sum(count(*)) over (partition by query_id) as n_terms from qexp group by query_id, term),
{weights_sql(['all'])},
top as (select query_id, doc_key, score, rank from (select *, row_number() over (partition by query_id order by score desc, doc_key) as rank from scored) where rank <= 3),
dw as (select distinct query_id, word from (select query_id, unnest({words(fold("title || ' ' || content"))}) as word from top join corpus using (doc_key))
  where length(word) > 2 and word not in {inlist(vocab.QUERY_STOP)}),
qw as (select distinct query_id, unnest(ws) as word from mw),
missing as (select query_id, word from qw where not exists (select 1 from dw where dw.query_id = qw.query_id and dw.word = qw.word)),
pairs as (select m.query_id, m.word, d.word as correction, {edits('m.word', 'd.word')} as dist from missing m join dw d
  on m.query_id = d.query_id and abs(length(m.word) - length(d.word)) <= 3),
fixes as (select query_id, word, correction, dist::bigint as dist from pairs where dist <= 3
  qualify row_number() over (partition by query_id, word order by dist, correction) = 1),
split as (select query_id, unnest(x) as w, generate_subscripts(x, 1) as i from (select query_id, {words('q')} as x from {asked})),
hints as (select s.query_id, case when count(f.word) = 0 then '' else string_agg(case when f.word is null then w
    when regexp_matches(w, '^\\p{{Lu}}') then upper(left(correction, 1)) || substr(correction, 2) else correction end, ' ' order by i) end as suggestion
  from split s left join fixes f on s.query_id = f.query_id and {fold('w')} = f.word group by s.query_id)"""


ORACLE["suggest_words"] = f"with {MISSPELT} select query_id, array_to_string({meaningful('q')}, ' ') as words from asked"
ORACLE["suggest_distance"] = f"""
with w as (select doc_id, unnest(x) as a, generate_subscripts(x, 1) as i from (select doc_id, {words('text')} as x from documents)),
p as (select doc_id, i, a, lead(a) over (partition by doc_id order by i) as b from w)
select doc_id, i::bigint as pos, least({edits('a', 'b')}, 4)::bigint as dist from p where b is not null"""
_SUGGEST = f"with {corpus()}, {MISSPELT}, {suggest_sql('asked')}"
ORACLE["suggest_fuzzy_docs"] = f"{_SUGGEST} select query_id, doc_key, rank, round(score, 6) as score from top"
ORACLE["suggest_vocab"] = f"{_SUGGEST} select query_id, word from dw"
ORACLE["suggest_corrections"] = f"{_SUGGEST} select query_id, word, correction, dist from fixes"
ORACLE["suggest_text"] = f"{_SUGGEST} select a.query_id, coalesce(suggestion, '') as suggestion from asked a left join hints h on a.query_id = h.query_id"

# --- snippets ------------------------------------------------------------------------------


def bytes_cut(x: str, n: int) -> str:
    """Longest prefix of at most n bytes."""
    return f"left({x}, list_max(list_filter(range(0, least(length({x}), {n}) + 1), lambda k: strlen(left({x}, k)) <= {n})))"


HITS = f"""{search_sql(True)}, {PAGES},
hits as (select query_id, doc_key, content as t, cleaned from page_hits join corpus using (doc_key) join cleaned using (query_id))"""
_phrases = "|".join(p.replace(".", "[.]") for p in vocab.BOILERPLATE_PHRASES)
CANDIDATES = f"""{HITS},
scan as (select *, {bytes_cut('t', 500)} as sc from hits),
folded as (select *, {rep(fold('sc'), chr(92) + 'p{Mn}')} as f,
  list_filter(range(1, length(sc) + 1), lambda j: not regexp_matches(substr(sc, j, 1), '\\p{{Mn}}')) as kept,
  list_filter({words(fold('cleaned'))}, lambda w: w not in {inlist(vocab.QUERY_STOP)} and strlen(w) > 1) as cw from scan),
cand_words as (select query_id, doc_key, t, f, kept, {rep('unnest(cw)', chr(92) + 'p{Mn}')} as w, generate_subscripts(cw, 1) - 1 as word_no from folded),
places as (select *, unnest(list_filter(range(0, length(f) - length(w) + 1), lambda i: substr(f, i + 1, length(w)) = w)) as i from cand_words where w <> '' and contains(f, w)),
bounds as (select query_id, doc_key, t, word_no, i, case when i = 0 then 0 else kept[i] end as s, kept[i + length(w)] as e from places),
sides as (select *, left(t, s) as lead, substr(t, e + 1) as rest from bounds),
cands as (select query_id, doc_key, t, word_no::bigint as word_no, i::bigint as occurrence, s::bigint as s, e::bigint as e, (
  case when regexp_matches(substr(t, s + 1, 1), '^\\p{{Lu}}') then 100 else 0 end
  + case when s = 0 then 30 when regexp_matches(lead, '(?:^|[.!?])[ \\t\\n\\r]*\\z') then 50 else 0 end
  + case when left(ltrim(rest, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) in ('(', '—', '–', '-') then 200 else 0 end
  - case when strlen(split_part(rest, chr(10), 1)) between 1 and 99 and contains(rest, chr(10)) and regexp_matches(lower(split_part(rest, chr(10), 1)), {q(_phrases)}) then 150 else 0 end
  - case when contains(lead, chr(10)) and regexp_matches(lower(regexp_extract(lead, '\\n([^\\n]*)\\z', 1)), {q(_phrases)}) then 100 else 0 end)::bigint as score from sides)"""
BEST = f"""{CANDIDATES},
limits as (select query_id, doc_key, min(word_no) as last_word from cands where score >= 300 group by all),
best as (select c.query_id, c.doc_key, t, s, e, score from cands c left join limits l on c.query_id = l.query_id and c.doc_key = l.doc_key
  where last_word is null or word_no <= last_word
  qualify row_number() over (partition by c.query_id, c.doc_key order by score desc, word_no, occurrence) = 1)"""


def window_sql(source: str) -> str:
    """CTEs from source(query_id, doc_key, t, at) to win(..., ws, we)."""
    back = "list_max(list_filter(range(0, least(at0, 150) + 1), lambda k: strlen(substr(t, at0 - k + 1, k)) <= 150))"
    return f"""
w1 as (select *, at0 - length(regexp_extract(substr(t, at0 - {back} + 1, {back}), '([^.!?\\n]*)\\z', 1)) as s0 from {source}),
w2 as (select * exclude (s0), s0 + length(regexp_extract(substr(t, s0 + 1), '^[ \\t\\n\\r]*', 0)) as ws from w1),
w3 as (select *, {bytes_cut('substr(t, ws + 1)', 250)} as cut from w2),
w4 as (select *, regexp_extract(cut, '(?s)^(.*) [^ ]*\\z', 1) as blank from w3),
win as (select * exclude (cut, blank), (case when strlen(substr(t, ws + 1)) <= 250 then length(t)
  when strlen(blank) > 120 then ws + length(blank) else ws + length(cut) end)::bigint as we from w4)"""


_columns = "query_id, doc_key"
ORACLE["snippet_candidates"] = f'with {CANDIDATES} select {_columns}, word_no, occurrence, s as start, e as "end", score from cands'
ORACLE["snippet_best"] = f'with {BEST} select {_columns}, s as start, e as "end", score from best'
ORACLE["snippet_window"] = f"""
with {BEST}, anchors as (select query_id, doc_key, t, s as at0 from best), {window_sql('anchors')}
select {_columns}, ws::bigint as start, we as "end" from win"""


def piece(a: str, b: str) -> str:
    return escape(f"substr(t, ({a}) + 1, ({b}) - ({a}))")


def highlight_sql(hits_cte: str) -> str:
    """CTEs from best and hits to snips(query_id, doc_key, snippet).

    Tokens never overlap, so only the chosen occurrence can clash: it loses to a token that comes
    first, and later tokens inside it lose to it.
    """
    return f"""{hits_cte},
hit_docs as (select distinct doc_key, t from hits), {spans_sql('hit_docs', 'doc_key', 't', 'sp', 'length')},
htok as (select *, {fold('piece')} as token from sp), hvoc as (select distinct token from htok where token not in {inlist(vocab.RUSSIAN_STOP)}),
{stems_sql('hvoc', 'hstems')},
found as (select query_id, doc_key, s, e from (select query_id, doc_key from hits) join (select doc_key, s, e, stem as term from htok join hstems using (token)) using (doc_key)
  join (select query_id, term from qterms) using (query_id, term)),
rng as (select *, false as chosen from found union all select query_id, doc_key, s, e, true from best b
  where exists (select 1 from found f where f.query_id = b.query_id and f.doc_key = b.doc_key)
  and not exists (select 1 from found f where f.query_id = b.query_id and f.doc_key = b.doc_key and f.s = b.s and f.e = b.e)),
anchors as (select h.query_id, h.doc_key, t, coalesce(any_value(b.s), min(f.s)) as at0 from hits h join found f using (query_id, doc_key)
  left join (select query_id, doc_key, s from best) b using (query_id, doc_key) group by all),
{window_sql('anchors')},
clipped as (select query_id, doc_key, t, ws, we, chosen, s as s0, e as e0, greatest(s, ws) as s, least(e, we) as e from rng join win using (query_id, doc_key) where e > ws and s < we),
shown as (select * from clipped where {fold(trim('substr(t, s + 1, e - s)'))} not in {inlist(vocab.QUERY_STOP)}),
chosen_ok as (select query_id, doc_key, s0, e0, e from shown c where chosen and not exists (select 1 from shown f where f.query_id = c.query_id
  and f.doc_key = c.doc_key and not f.chosen and (f.s0 < c.s0 or (f.s0 = c.s0 and f.e0 > c.e0)) and f.e > c.s)),
accepted as (select query_id, doc_key, t, ws, we, s, e from shown x where (chosen and exists (select 1 from chosen_ok c where c.query_id = x.query_id and c.doc_key = x.doc_key))
  or (not chosen and not exists (select 1 from chosen_ok c where c.query_id = x.query_id and c.doc_key = x.doc_key
    and (x.s0 > c.s0 or (x.s0 = c.s0 and x.e0 < c.e0)) and x.s < c.e))),
steps as (select *, coalesce(lag(e) over (partition by query_id, doc_key order by s, e), ws) as prev from accepted),
bodies as (select query_id, doc_key, string_agg({piece('prev', 's')} || '<mark>' || {piece('s', 'e')} || '</mark>', '' order by s) as body, max(e) as last from steps group by all),
snips as (select w.query_id, w.doc_key, case when regexp_matches(left(t, ws), '[^ \\t\\n\\r]') then '...' else '' end
  || coalesce(body, '') || {piece('coalesce(last, ws)', 'we')} || case when we < length(t) then '...' else '' end as snippet
  from win w left join bodies b on w.query_id = b.query_id and w.doc_key = b.doc_key
  union all select query_id, doc_key, case when t = '' then '' else {truncate('t')} end from hits h
  where not exists (select 1 from found f where f.query_id = h.query_id and f.doc_key = h.doc_key))"""


ORACLE["highlight"] = f"with {highlight_sql(BEST)} select query_id, doc_key, snippet from snips"

# The fuzzy part reuses names of the plain search, so it runs as a subquery of its own.
_EMPTY = "(select * from asked where q <> '' and query_id not in (select query_id from kept))"
ORACLE["search_response"] = f"""
with {search_sql(asked=REQUESTS)}, {TOTALS}, {PAGES}, {DEDUPE},
lists as (select query_id, count(*) as n_results, string_agg(doc_key || '|' || {TIER} || '|' || title, chr(10) order by rank) as hits
  from kept join totals using (query_id) group by query_id),
unanswered as (select query_id, q from {_EMPTY}),
fuzzy as (with {suggest_sql('unanswered')} select query_id, suggestion from hints)
select a.query_id, coalesce(total, 0)::bigint as total, page, size as "pageSize", ((coalesce(total, 0) + size - 1) // size)::bigint as "totalPages",
  (select count(*) from documents) as "indexedPages", coalesce(n_results, 0)::bigint as n_results, coalesce(hits, '') as hits, coalesce(suggestion, '') as suggestion
from asked a left join totals t on a.query_id = t.query_id left join lists l on a.query_id = l.query_id left join fuzzy f on a.query_id = f.query_id"""

_named = "'indexedPages,page,pageSize,results,' || case when coalesce(suggestion, '') = '' then '' else 'suggestion,' end || 'total,totalPages'"
ORACLE["response_json"] = (
    ORACLE["search_response"].replace("string_agg(doc_key", "string_agg('0|' || doc_key").replace(
        "coalesce(suggestion, '') as suggestion", f"nullif(suggestion, '') as suggestion, {_named} as names")
)

# --- keyword in context --------------------------------------------------------------------

KWIC_DOCS = (
    f"asked as (select doc_id, {cyr('d.text')} as t, {cyr('b.text')} as q from documents d join benchmark b "
    "on b.item_id = d.doc_id % (select count(*) from benchmark))"
)
_ending = r"(?s)^(.{3,}?)(?:" + "|".join(vocab.LIGHT_ENDINGS) + r")$"


def kwic_words(x: str) -> str:
    plain = rep(fold(x), "[^A-Za-z0-9_а-яё]", " ")
    return f"list_filter(string_split_regex({plain}, ' +'), lambda w: length(w) >= 3 and w not in {inlist(vocab.KWIC_STOP)})"


def light(x: str) -> str:
    return rf"regexp_replace({fold(x)}, {q(_ending)}, '\1')"


ORACLE["kwic_words"] = f"with {KWIC_DOCS} select doc_id, array_to_string({kwic_words('t')}, ' ') as words from asked"
ORACLE["light_stem"] = f"with {CYR_VOCABULARY} select token, {light('token')} as stem from voc"
def kwic_found(first_only: bool = False) -> str:
    """CTEs to found(doc_id, word_no, word, at0, matched). `first_only`: words after the first one found directly are not looked up by stem."""
    before = "and word_no < coalesce((select min(d.word_no) from direct d where d.doc_id = direct.doc_id and d.at0 >= 0), word_no + 1)" if first_only else ""
    return f"""{KWIC_DOCS},
kw as (select doc_id, t, unnest(ws) as word, (generate_subscripts(ws, 1) - 1)::bigint as word_no from (select doc_id, t, {kwic_words('q')} as ws from asked)),
direct as (select doc_id, word, word_no, instr({fold('t')}, word) - 1 as at0 from kw),
{spans_sql('asked', 'doc_id', 't', 'sp', 'length', '(?i)[а-яёa-z]+')},
ktok as (select doc_id, s, piece, {fold('piece')} as low, {light('piece')} as stem from sp),
lost as (select doc_id, word, word_no, {light('word')} as ws from direct where at0 < 0 {before}),
by_stem as (select l.doc_id, l.word_no, min(k.s) as at0, arg_min(k.piece, k.s) as matched from lost l join ktok k
  on l.doc_id = k.doc_id and (k.stem = l.ws or starts_with(k.low, l.ws)) group by all),
found as (select d.doc_id, d.word_no, d.word, (case when d.at0 >= 0 then d.at0 else coalesce(b.at0, -1) end)::bigint as at0,
  case when d.at0 >= 0 then d.word else coalesce(matched, '') end as matched
  from direct d left join by_stem b on d.doc_id = b.doc_id and d.word_no = b.word_no)"""


EXCERPTS = f"""{kwic_found(first_only=True)},
firsts as (select doc_id, at0, matched from found where at0 >= 0 qualify row_number() over (partition by doc_id order by word_no) = 1),
edges as (select doc_id, t, q, at0, at0 + length(matched) as stop, greatest(0, at0 - 150) as a0, least(length(t), at0 + length(matched) + 150) as b0
  from asked join firsts using (doc_id)),
gaps as (select *, instr(substr(t, a0 + 1, at0 - a0), ' ') as gap, substr(t, stop + 2, b0 - stop) as behind from edges),
cuts as (select *, case when a0 > 0 and gap > 0 then a0 + gap else a0 end as a,
  case when b0 < length(t) and contains(behind, ' ') then stop + 1 + length(regexp_extract(behind, '(?s)^(.*) [^ ]*\\z', 1)) else b0 end as b from gaps),
excerpts as (select x.doc_id, x.q, case when c.doc_id is null then case when length(x.t) > 200 then left(x.t, 200) || '...' else x.t end
  else case when a > 0 then '...' else '' end || substr(c.t, a + 1, b - a) || case when b < length(c.t) then '...' else '' end end as excerpt
  from asked x left join cuts c on x.doc_id = c.doc_id)"""
ORACLE["kwic_find"] = f'with {kwic_found()} select doc_id, word_no, word, at0 as "at", matched from found'
ORACLE["kwic_snippet"] = f"with {EXCERPTS} select doc_id, excerpt from excerpts"
_pattern = f"'(?i)(?:' || array_to_string(list_transform({kwic_words('q')}, lambda w: {light('w')}), '|') || ')[а-яёa-z]*'"
ORACLE["kwic_highlight"] = f"""
with {EXCERPTS}, marked as (select doc_id, excerpt, len({kwic_words('q')}) as n, string_split(regexp_replace(excerpt, {_pattern}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) as p from excerpts),
parts as (select doc_id, unnest(p) as x, generate_subscripts(p, 1) as i from marked where n > 0)
select doc_id, string_agg(case when i % 2 = 0 then '<strong>' || {escape('x')} || '</strong>' else {escape('x')} end, '' order by i) as marked from parts group by doc_id
union all select doc_id, {escape('excerpt')} from marked where n = 0"""
