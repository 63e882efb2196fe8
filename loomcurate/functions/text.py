"""Scalar text functions, all JVM-side."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..taxonomy import ALLOWED_LEADS, BRANDS

#: Unicode white space, with the separators that Python's str.split also takes.
_BLANK = "[\\s\\x1c-\\x1f]+"
_BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Pre-tokens: runs of letters, up to three digits, other marks. Approximates a BPE length; it is not one.
PRE_TOKEN = "\\p{L}+|\\p{N}{1,3}|[^\\s\\p{L}\\p{N}]+"
_EDGE_BEFORE, _EDGE_AFTER = "(^|[^\\p{L}\\p{N}_])", "([^\\p{L}\\p{N}_]|$)"


def normalize_url(url: Column) -> Column:
    """Lower-case scheme, authority as written, path without parameters and trailing slashes; no query or fragment.

    Text without ``scheme://`` keeps its path part.
    """
    scheme = F.lower(F.regexp_extract(url, "^([^:/?#]+)://", 1))
    authority = F.regexp_extract(url, "^[^:/?#]+://([^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, "^[^:/?#]+://[^/?#]*([^?#]*)", 1), ";[^/]*$", ""), "/+$", "")
    plain = F.regexp_replace(F.regexp_extract(url, "^([^?#]*)", 1), "/+$", "")
    return F.when(scheme == "", plain).otherwise(F.concat(scheme, F.lit("://"), authority, path))


def url_id(url: Column) -> Column:
    """Id of a post: SHA-256 of its (normalised) URL."""
    return F.sha2(url, 256)


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"(?U){_BLANK}"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def truncate_words(text: Column, most: int) -> Column:
    """Texts of more than ``most`` words cut to those, joined by single spaces; shorter texts as they are."""
    return F.when(word_count(text) > most, F.array_join(F.slice(words(text), 1, most), " ")).otherwise(text)


def fill(template: Column, values: dict[str, Column]) -> Column:
    """``{name}`` slots filled one after another, in the given order; a value may bring slots for later ones."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def joined(items: Column, empty: str = "") -> Column:
    return F.when(F.size(items) > 0, F.array_join(items, ", ")).otherwise(F.lit(empty))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def is_blank(text: Column) -> Column:
    return F.coalesce(stripped(text), F.lit("")) == ""


def normalized_hash(text: Column) -> Column:
    """SHA-256 of the stripped, lower-cased text."""
    return F.sha2(F.lower(stripped(text)), 256)


def question_id(post_id: Column, position: Column, question: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", post_id, position.cast("string"), F.substring(question, 1, 50)), 256), 1, 16)


def multi_turn_id(post_id: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.lit("mt:"), post_id), 256), 1, 16)


def pre_token_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(PRE_TOKEN), F.lit(0)))


def _quoted(term: str) -> str:
    return "".join(f"\\{c}" if c in r"\.^$|?*+()[]{}" else c for c in term)


def brand_pattern(terms: list[str]) -> str:
    """Terms as whole words; letters, digits and the underscore of any script are word characters."""
    return f"{_EDGE_BEFORE}({'|'.join(map(_quoted, terms))}){_EDGE_AFTER}"


def allowed_pattern(leads: list[str]) -> str:
    """A lead, a space and at least one more character on its line."""
    return "(" + "|".join(f"{_quoted(x)} [^\\n]" for x in leads) + ")"


def brand_leak(text: Column, terms: list[str] = BRANDS, leads: list[str] = ALLOWED_LEADS) -> Column:
    """The first term, in list order, that the text names; null if none, or if an allowed lead occurs anywhere."""
    low = F.lower(text)
    plain = [t for t in terms if re.fullmatch(r"\w+", t)]  # these cannot overlap, so one scan finds them all
    hits = F.regexp_extract_all(low, F.lit(f"(?<![\\p{{L}}\\p{{N}}_])({'|'.join(plain)})(?![\\p{{L}}\\p{{N}}_])"), F.lit(1)) if plain else F.array().cast("array<string>")
    others = [F.when(low.rlike(brand_pattern([t])), F.lit(i).cast("long")) for i, t in enumerate(terms, 1) if t not in plain]
    places = F.concat(F.transform(hits, lambda t: F.array_position(F.lit(terms), t)), F.array(*others) if others else F.array().cast("array<bigint>"))
    return F.when(~low.rlike(allowed_pattern(leads)), F.get(F.lit(terms), F.coalesce(F.array_min(places), F.lit(0)).cast("int") - 1))


def brand_reason(leak: Column) -> Column:
    return F.coalesce(F.concat(F.lit("Brand leak: "), leak), F.lit("OK"))


# What is taken out of a page's HTML, in order, and the entities that are restored.
_DROPPED = ["(?s)<!--.*?-->"] + [f"(?is)<{tag}[^>]*>.*?</{tag}>" for tag in ("script", "style", "nav", "footer")]
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")]


_LINK = "(?is)<a\\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def _character(number: Column) -> Column:
    """The character of a decimal code point."""
    return F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")


def _numbered(text: Column) -> Column:
    """``text`` with decimal entities restored."""
    numbers = F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{2,6});"), F.lit(1)))
    return F.aggregate(numbers, text, lambda s, n: F.replace(s, F.concat(F.lit("&#"), n, F.lit(";")), _character(n)))


def html_text(html: Column) -> Column:
    """Main text of a page: scripts first, links as [text](address), cells by bars, block ends as line ends, other tags as
    spaces, entities restored. Null where nothing is left."""
    out = html
    for pattern in _DROPPED:
        out = F.regexp_replace(out, pattern, "")
    out = F.regexp_replace(out, _LINK, "[$2]($1)")
    out = F.regexp_replace(F.regexp_replace(out, "(?i)</t[dh]>", " | "), "(?i)</(p|div|h[1-6]|li|tr)>|<br\\s*/?>", "\n")
    out = F.regexp_replace(F.regexp_replace(out, "<[^>]+>", " "), "[ \\t]+", " ")
    for entity, char in _ENTITIES[:-1]:
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.transform(F.array(out), _numbered)[0]  # the text so far is computed once
    out = F.replace(out, F.lit(_ENTITIES[-1][0]), F.lit(_ENTITIES[-1][1]))
    out = F.btrim(F.regexp_replace(F.regexp_replace(out, " ?\\n ?", "\n"), "\\n{2,}", "\n"), F.lit(" \n"))
    return F.nullif(out, F.lit(""))


def html_title(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def html_meta(html: Column, name: str) -> Column:
    """Content of ``<meta name=... content=...>``, in any order and with either quote; null if absent or empty."""
    return first_filled(*[F.regexp_extract(html, p, g) for p in meta_patterns(name) for g in (1, 2)])


def meta_patterns(name: str) -> list[str]:
    named, content = f"(?:name|property)\\s*=\\s*[\"']{name}[\"']", "content\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)')"
    return [f"(?is)<meta\\s[^>]*{named}[^>]*{content}", f"(?is)<meta\\s[^>]*{content}[^>]*{named}"]


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])
