"""HTML to text as column expressions: element removal, paragraphs, titles, links, entities."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.functions.arrays import any_of, let, pieces
from loomdex.functions.text import ASCII_SPACE, normalize_ws, trim_space, wiki_scrub

# Quoted attribute values may hold `>`; a tag with an odd quote ends at the next `>`.
TAG = r"</?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-zA-Z][^>]*>"
_ATTRIBUTES = "(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
MARKUP = TAG + r"|<[!?/][^>]*>"
P_OPEN = rf"(?i)<p(?:\s{_ATTRIBUTES})?>"
BODY_OPEN = rf"(?i)<body(?:\s{_ATTRIBUTES})?>"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
VOID_TAGS = "area base br col embed hr img input link meta source track wbr".split()
# A paragraph ends where any of these opens or closes.
PARAGRAPH_END = (
    r"(?is)</?(?:p|address|article|aside|blockquote|body|center|dd|details|dialog|div|dl|dt|fieldset|figcaption|"
    r"figure|footer|form|h[1-6]|header|hgroup|hr|html|li|main|menu|nav|ol|pre|section|summary|table|tbody|td|tfoot|"
    r"th|thead|tr|ul)(?:\s[^>]*|/)?>"
)
# Named references of HTML5, as the standard library lists them: with their semicolon, or without where that is allowed.
# All of them are one constant of the plan, in groups by their first two letters, as a map is searched from its start.
_GROUPS: dict[str, dict[str, str]] = {}
for _name, _text in html5.items():
    _GROUPS.setdefault(_name[:2], {})[_name] = _text
ENTITIES = json.dumps(_GROUPS)
# Looked up before the others.
USUAL = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;")
# Cuts are gathered in blocks, since a list is copied whenever it grows.
CUT_BLOCK = 64
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);?"


def decode_entities(c: Column) -> Column:
    """Decode named and numeric references in one pass, so `&amp;lt;` stays `&lt;`."""
    usual = F.create_map(*[F.lit(x) for n in USUAL for x in (n, html5[n])])
    table = F.from_json(F.lit(ENTITIES), "map<string,map<string,string>>")

    def named(ref: Column) -> Column:
        return F.coalesce(F.try_element_at(usual, ref), F.try_element_at(F.try_element_at(table, F.left(ref, F.lit(2))), ref))

    def code_point(name: Column) -> Column:
        digits = F.when(
            name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)
        ).otherwise(F.substring(name, 2, 7))
        return digits.try_cast("bigint")

    def one(ref: Column) -> Column:
        name = F.regexp_replace(ref, "[&;]", "")
        cp = code_point(name)
        scalar = cp.between(1, 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
        numeric = F.when(
            scalar, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
        ).otherwise(F.lit("\ufffd"))
        return F.when(F.startswith(name, F.lit("#")), numeric).otherwise(
            F.coalesce(named(F.substring(ref, 2, 64)), ref)
        )

    decoded = F.array_join(
        F.transform(pieces(c, ENTITY), lambda p, i: F.when(i % 2 == 1, one(p)).otherwise(p)), ""
    )
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def _class_of(tag: Column) -> Column:
    value = F.regexp_extract(tag, r"(?is)\sclass\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    return F.concat(F.lit(" "), F.regexp_replace(value, r"[\"'\t\n\f\r ]+", " "), F.lit(" "))


def _is_dropped(tag: Column, name: Column) -> Column:
    def has_class(css: str) -> Column:
        return F.contains(_class_of(tag), F.lit(f" {css} "))

    return (
        name.isin(vocab.DROPPED_TAGS)
        | any_of(has_class(c) for c in vocab.DROPPED_CLASSES)
        | ((name == "table") & has_class(vocab.DROPPED_TABLE_CLASS))
    )


def drop_elements(html: Column) -> Column:
    """Remove unwanted elements with everything inside, nested same-name elements included."""

    def cut(parts: Column) -> Column:
        names = F.transform(
            parts,
            lambda p, i: F.when(
                i % 2 == 1, F.lower(F.regexp_extract(p, r"^<(/?[a-zA-Z][a-zA-Z0-9:\-]*)", 1))
            ).otherwise(F.lit("")),
        )
        # A cheap text test runs first: most tags can be ruled out without looking at classes.
        opens = let(names, lambda ns: F.transform(
            parts,
            lambda p, i: F.when(
                (i % 2 == 1)
                & ~F.startswith(F.get(ns, i), F.lit("/"))
                & (F.get(ns, i).isin(vocab.DROPPED_TAGS) | p.rlike(r"(?i)\sclass\b")),
                _is_dropped(p, F.get(ns, i)),
            ).otherwise(F.lit(False)),
        ))
        return let(names, lambda ns: let(opens, lambda os: let(_dropped_pieces(ns, os), lambda cuts: _without(parts, cuts))))

    return let(pieces(html, TAG), cut)


def _dropped_pieces(names: Column, opens: Column) -> Column:
    """array<struct<first,last>>: piece ranges of the outermost dropped elements, in one pass over the tags."""
    none = F.expr("cast(array() as array<struct<first:int,last:int>>)")
    no_blocks = F.expr("cast(array() as array<array<struct<first:int,last:int>>>)")

    def state(name, depth, first, cuts, blocks) -> Column:
        return F.struct(name.alias("name"), depth.alias("depth"), first.alias("first"), cuts.alias("cuts"), blocks.alias("blocks"))

    start = state(F.lit(""), F.lit(0), F.lit(0), none, no_blocks)

    def ended(acc: Column, first: Column, last: Column) -> Column:
        piece = F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"))
        full = F.size(acc["cuts"]) >= CUT_BLOCK
        cuts = F.when(full, F.array(piece)).otherwise(F.concat(acc["cuts"], F.array(piece)))
        blocks = F.when(full, F.concat(acc["blocks"], F.array(acc["cuts"]))).otherwise(acc["blocks"])
        return state(F.lit(""), F.lit(0), F.lit(0), cuts, blocks)

    def all_cuts(acc: Column) -> Column:
        return F.flatten(F.concat(acc["blocks"], F.array(acc["cuts"])))

    def step(acc: Column, i: Column) -> Column:
        name = F.get(names, i)
        depth = acc["depth"] + F.when(name == acc["name"], 1).when(name == F.concat(F.lit("/"), acc["name"]), -1).otherwise(0)
        inside = F.when(depth == 0, ended(acc, acc["first"], i)).otherwise(
            state(acc["name"], depth, acc["first"], acc["cuts"], acc["blocks"])
        )
        outside = F.when(~F.get(opens, i), acc).when(name.isin(VOID_TAGS), ended(acc, i, i)).otherwise(
            state(name, F.lit(1), i, acc["cuts"], acc["blocks"])
        )
        return F.when(acc["name"] == "", outside).otherwise(inside)

    tags = F.when(F.size(names) > 1, F.sequence(F.lit(1), F.size(names) - 2, F.lit(2))).otherwise(F.expr("cast(array() as array<int>)"))
    return F.aggregate(
        tags, start, step,
        lambda acc: F.when(acc["name"] == "", all_cuts(acc)).otherwise(all_cuts(ended(acc, acc["first"], F.size(names) - 1))),
    )


def _without(parts: Column, cuts: Column) -> Column:
    """The pieces between the cuts, as one text."""
    starts = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c["last"] + 1))
    ends = F.concat(F.transform(cuts, lambda c: c["first"]), F.array(F.size(parts)))
    return F.array_join(F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(parts, s + 1, e - s))), "")


def strip_unwanted(html: Column) -> Column:
    return drop_elements(F.regexp_replace(html, HIDDEN, ""))


def text_of(fragment: Column) -> Column:
    """Text nodes of a fragment: tags vanish, entities are decoded."""
    return decode_entities(F.regexp_replace(fragment, MARKUP, ""))


def paragraphs(stripped: Column) -> Column:
    """Trimmed texts of all paragraphs that have any."""
    after_p = F.split(stripped, P_OPEN)
    bodies = F.transform(
        F.slice(after_p, F.lit(2), F.greatest(F.size(after_p) - 1, F.lit(1))),
        lambda s: trim_space(text_of(F.get(F.split(s, PARAGRAPH_END, 2), F.lit(0)))),
    )
    return F.filter(bodies, lambda t: t != "")


def paragraph_text(stripped: Column) -> Column:
    """Trimmed text of every paragraph, each followed by one blank."""
    return F.array_join(F.transform(paragraphs(stripped), lambda t: F.concat(t, F.lit(" "))), "")


def _body(stripped: Column) -> Column:
    without_head = F.regexp_replace(stripped, r"(?is)<head\b.*?</head\s*>|<title\b.*?</title\s*>", "")
    inner = F.get(F.split(without_head, BODY_OPEN, 2), F.lit(1))
    return F.coalesce(inner, without_head)


def body_text(stripped: Column) -> Column:
    return text_of(_body(stripped))


def body_lines(stripped: Column) -> Column:
    """The body's texts between block tags."""
    one_line = F.regexp_replace(_body(stripped), f"{ASCII_SPACE}+", " ")
    blocks = F.split(F.regexp_replace(one_line, PARAGRAPH_END, "\n"), "\n")
    return F.filter(F.transform(blocks, lambda b: normalize_ws(text_of(b))), lambda t: t != "")


def page_lines(html: Column) -> Column:
    """Text of a page with a line per block: its paragraphs, or the body where they hold too little."""

    def of(stripped: Column) -> Column:
        long = F.aggregate(paragraphs(stripped), F.lit(0), lambda n, t: n + F.octet_length(t) + 1)
        lines = F.when(long < vocab.MIN_PARAGRAPH_BYTES, body_lines(stripped)).otherwise(
            F.transform(paragraphs(stripped), normalize_ws)
        )
        return F.array_join(lines, "\n")

    return let(strip_unwanted(html), of)


def visible_text(stripped: Column) -> Column:
    return let(
        paragraph_text(stripped),
        lambda t: F.when(
            F.octet_length(t) < vocab.MIN_PARAGRAPH_BYTES, body_text(stripped)
        ).otherwise(t),
    )


def html_to_text(html: Column) -> Column:
    """Unwanted elements out, paragraphs (or the body) as text, remnants scrubbed, blanks folded."""
    return normalize_ws(wiki_scrub(let(strip_unwanted(html), visible_text)))


def title(html: Column) -> Column:
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1)
    return normalize_ws(decode_entities(raw))


def hrefs(html: Column) -> Column:
    """Link targets in page order; comments, scripts and styles are not searched."""
    visible = F.regexp_replace(html, HIDDEN, "")
    anchors = F.regexp_extract_all(visible, F.lit(r"(?is)<a\s[^>]*>"), F.lit(0))
    attribute = r"(?is)[\s\"']href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
    values = F.transform(
        F.filter(anchors, lambda a: a.rlike(attribute)),
        lambda a: decode_entities(
            F.regexp_replace(F.regexp_extract(a, attribute, 1), r"^[\"']|[\"']\z", "")
        ),
    )
    return values
