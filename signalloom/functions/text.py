"""Text columns: whitespace, slugs, URLs, tokens, titles and links."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

from signalloom.functions import constants as C


def compact(col: Column) -> Column:
    """Collapse Unicode white space to single blanks and trim; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"(?U)\s+", " "))


def fold(col: Column) -> Column:
    """Case folding: lower case plus the sharp s, the only Latin letter the two differ on."""
    return F.replace(F.lower(col), F.lit("ß"), F.lit("ss"))


def folded_title(col: Column) -> Column:
    return fold(compact(col))


def ascii_letters(col: Column) -> Column:
    """Latin letters without their marks; other non-ASCII characters are dropped."""
    plain = F.translate(F.lower(col), C.ACCENTED, C.UNACCENTED)
    return F.regexp_replace(plain, r"[^\x00-\x7F]", "")


def slug(col: Column) -> Column:
    dashed = F.regexp_replace(ascii_letters(col), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def canonical_url(col: Column) -> Column:
    return F.regexp_replace(F.substring_index(F.coalesce(col, F.lit("")), "#", 1), "/+$", "")


_LETTERS, _LONGEST = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 40


def _named_characters() -> Column:
    """All named references (with and without the semicolon) as one array literal of short lists, a place for each
    first letter and length: a name is looked for among the few that share both."""
    lists = [""] * (len(_LETTERS) * _LONGEST)
    for name, value in sorted(html5.items()):
        lists[_LETTERS.index(name[0]) * _LONGEST + len(name)] += f"\x01{name}\x02{value}"
    return F.split(F.lit("\x03".join(lists)), "\x03")


def _named(name: Column, lists: Column) -> Column:
    """Text of a named reference, null where there is none."""
    place = (F.instr(F.lit(_LETTERS), F.substring(name, 1, 1)) - 1) * _LONGEST + F.length(name)
    found = F.when((F.length(name) > 1) & (F.length(name) < _LONGEST), F.get(lists, place))
    mark = F.concat(F.lit("\x01"), name, F.lit("\x02"))
    return F.when(F.contains(found, mark), F.substring_index(F.call_function("substring_index", found, mark, F.lit(-1)), "\x01", 1))


def _referred(ref: Column, named: Column) -> Column:
    """Text of one character reference; unknown names stay as they are."""
    digits = F.regexp_extract(ref, "^&#[xX]?([0-9a-fA-F]+)", 1)
    code = F.conv(digits, 16, 10).cast("long")
    code = F.when(F.substring(F.lower(ref), 3, 1) == "x", code).otherwise(F.try_to_number(F.regexp_extract(ref, "^&#([0-9]+)", 1), F.lit("9" * 9)).cast("long"))
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    wrong = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    number = F.when(wrong, F.lit("\ufffd")).when(code.between(128, 159), F.substring(F.lit(C.C1_CHARACTERS), (code - 127).cast("int"), F.lit(1))).otherwise(char)
    return F.when(ref.startswith("&#"), number).otherwise(F.coalesce(_named(F.substring(ref, 2, _LONGEST), named), ref))


def unescape(col: Column) -> Column:
    """Decimal, hexadecimal and named character references, each decoded once; null becomes empty.

    References meet the text behind them pairwise: a list named inside a lambda would be made anew for each.
    """
    text = F.coalesce(col, F.lit(""))
    named = _named_characters()
    refs, gaps = F.regexp_extract_all(text, F.lit(C.CHARACTER_REFERENCE), F.lit(0)), F.split(text, C.CHARACTER_REFERENCE)
    decoded = F.zip_with(refs, F.slice(gaps, F.lit(2), F.size(gaps)), lambda r, gap: F.concat(_referred(r, named), gap))
    return F.when(F.contains(text, F.lit("&")), F.concat(F.get(gaps, F.lit(0)), F.concat_ws("", decoded))).otherwise(text)


def strip_tags(col: Column) -> Column:
    return compact(unescape(F.regexp_replace(F.coalesce(col, F.lit("")), "<[^>]+>", " ")))


def searchable(*cols: Column) -> Column:
    """Title, summary and list columns joined by blanks, whole and unclipped."""
    return F.concat_ws(" ", *cols)


def normalized_tokens(col: Column) -> Column:
    """Array of lower-case tokens; `.`, `+`, `#` join inside a token, all else separates, white space, hyphen and slash too."""
    return F.regexp_extract_all(fold(F.coalesce(col, F.lit(""))), F.lit(C.TOKEN_PATTERN), F.lit(0))


def normalized_text(col: Column) -> Column:
    return F.array_join(normalized_tokens(col), " ")


def padded(col: Column) -> Column:
    return F.concat(F.lit(" "), col, F.lit(" "))


def contains_phrase(text: Column, phrase: Column) -> Column:
    return (phrase != "") & F.contains(padded(text), padded(phrase))


def phrase_position(text: Column, phrase: Column) -> Column:
    """Offset of a phrase in normalized text, -1 if absent or at the very start.

    The start counts as absent because the padded search is shifted by one; relation results
    depend on it.
    """
    return F.greatest(F.lit(-1), F.instr(padded(text), padded(phrase)) - 2)


def stable_id(prefix: Column, *parts: Column, digits: int = 20) -> Column:
    return F.concat(prefix, F.lit(":"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, digits))


def clean_title(col: Column) -> Column:
    """Editorial title: outer marks stripped, no blank before punctuation or after a bracket."""
    t = F.regexp_replace(compact(col), r"^[ \-|•]+|[ \-|•]+$", "")
    t = F.regexp_replace(t, r"\s+([,.;:!?])", "$1")
    return F.regexp_replace(t, r"([\(\[\{])\s+", "$1")


def drop_leading_marker(col: Column) -> Column:
    return F.regexp_replace(col, C.LEADING_MARKER, "")


def spaced_letters(title: Column) -> Column:
    """True for titles that are mostly single letters (eight tokens or more)."""
    tokens = F.filter(F.split(title, " "), lambda t: t != "")
    bare = F.transform(tokens, lambda t: F.regexp_replace(t, r"""^[.,:;!?&'"\-]+|[.,:;!?&'"\-]+$""", ""))
    single = F.size(F.filter(bare, lambda t: F.length(t) == 1))
    return (F.size(tokens) >= 8) & (single >= F.size(tokens) * C.SPACED_LETTER_RATIO)


def word_count(col: Column) -> Column:
    return F.size(F.filter(F.split(col, " "), lambda t: t != ""))


def editorial_title(col: Column) -> Column:
    """Clean title, null when it fails the editorial quality rules."""
    title = clean_title(drop_leading_marker(col))
    bad = (
        spaced_letters(title)
        | (F.length(title) < 32)
        | (word_count(title) < 5)
        | title.rlike(C.IGNORED_LINK_TEXT)
    )
    return F.when(~bad, title)


def generic_title(col: Column) -> Column:
    title = F.regexp_replace(compact(drop_leading_marker(col)), r"^[ \-|•]+|[ \-|•]+$", "")
    bad = (F.length(title) < 14) | (word_count(title) < 3) | title.rlike(C.GENERIC_IGNORED_LINK_TEXT)
    return F.when(~bad, title)


def is_web_url(col: Column) -> Column:
    return col.rlike(r"^(?i:https?)://[^/?#\s]+")


def url_host(col: Column) -> Column:
    authority = F.regexp_extract(F.lower(col), r"^https?://([^/?#]+)", 1)
    return F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r":\d*$", "")


def query_value(url: Column, key: str) -> Column:
    """First decoded value of a query key, empty when absent."""
    raw = F.regexp_extract(url, rf"[?&]{key}=([^&#]*)", 1)
    return F.coalesce(F.try_url_decode(raw), F.lit(""))


def public_link(col: Column) -> Column:
    """Unwrap a redirect parameter, drop tracking keys and the fragment; null for non-web links."""
    raw = F.replace(col, F.lit("&amp;"), F.lit("&"))
    url = raw
    for key in reversed(C.REDIRECT_QUERY_KEYS):
        target = query_value(raw, key)
        url = F.when(is_web_url(target), target).otherwise(url)
    bare = F.substring_index(url, "#", 1)
    base = F.substring_index(bare, "?", 1)
    query = F.when(F.instr(bare, "?") > 0, F.regexp_replace(bare, r"^[^?]*\?", "")).otherwise(F.lit(""))

    def kept(part: Column) -> Column:
        key = F.lower(F.substring_index(part, "=", 1))
        has_value = F.length(F.regexp_replace(part, r"^[^=]*=?", "")) > 0
        return has_value & ~key.isin(*C.TRACKING_QUERY_KEYS) & ~key.startswith("utm_")

    rest = F.array_join(F.filter(F.split(query, "&"), kept), "&")
    clean = F.when(rest != "", F.concat(base, F.lit("?"), rest)).otherwise(base)
    return F.when(is_web_url(raw), clean)


def issue_url(html: Column, prefix: str, default: str) -> Column:
    """Public issue page of the first link in `html` that carries a valid campaign id."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""https?://[^\s"'<>]+"""), F.lit(0))
    ids = F.transform(links, lambda u: query_value(F.replace(u, F.lit("&amp;"), F.lit("&")), "cid"))
    valid = F.filter(ids, lambda c: c.rlike("^[a-zA-Z0-9_-]{8,64}$"))
    return F.when(F.size(valid) > 0, F.concat(F.lit(prefix), F.get(valid, F.lit(0)))).otherwise(F.lit(default))


def sender_address(col: Column) -> Column:
    bracketed = F.regexp_extract(col, r"<([^<>]*)>", 1)
    return F.lower(F.trim(F.when(bracketed != "", bracketed).otherwise(col)))


def sender_domain(col: Column) -> Column:
    address = sender_address(col)
    return F.when(F.contains(address, F.lit("@")), F.substring_index(address, "@", -1)).otherwise(F.lit(""))


def title_from_url(col: Column) -> Column:
    path = F.regexp_replace(F.regexp_extract(col, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), "/+$", "")
    last = F.substring_index(path, "/", -1)
    words = compact(F.regexp_replace(F.coalesce(F.try_url_decode(last), last), "[-_]+", " "))
    return F.initcap(words)


def lead_entity(col: Column) -> Column:
    """Text before a release verb, else the first four words; lower case, words only."""
    cleaned = F.trim(F.regexp_replace(col, "^[^A-Za-z0-9]+", ""))
    before = F.regexp_extract(cleaned, rf"(?i)^(.{{2,55}}?)\s+(?:{'|'.join(C.RELEASE_VERBS)})\b", 1)
    words = F.filter(F.split(compact(cleaned), " "), lambda w: w != "")
    lead = F.when(before != "", before).otherwise(F.array_join(F.slice(words, 1, 4), " "))
    return F.trim(F.regexp_replace(F.lower(lead), "[^a-z0-9]+", " "))


def clip(col: Column, size: int) -> Column:
    """Display text of a post: cut to `size` characters with an ellipsis."""
    cut = F.concat(F.rtrim(F.substring(col, 1, size - 3)), F.lit("..."))
    return F.when(F.length(col) > size, cut).otherwise(col)


def without_source_prefix(error: Column) -> Column:
    """Message part of a `source: message` line; the whole line when there is none."""
    message = F.trim(F.regexp_replace(error, "^[^:]*:?", ""))
    return F.when(message != "", message).otherwise(error)
