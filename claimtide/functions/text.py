"""Text column functions; every one stays inside the JVM."""

from __future__ import annotations

import json
import unicodedata
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ASCII_PUNCTUATION = r"[!-/:-@\[-`{-~]"
URL_PATTERN = r"https?://[!$-_a-z]+"
NOT_WORD_LETTERS = r"[^ \nA-Za-z0-9À-ÖØ-öø-ÿЀ-ӿ/]+"
NOT_LETTERS_OR_SPACE = r"[^\p{L} ]"
WHITESPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
HOST_PREFIX = r"https?://[w.]{0,4}"
NAME_SEPARATORS = ["/", " - ", "  ", ". Ed. ", " de ", " en ", " Ed. "]


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _accent_tables() -> tuple[str, str]:
    """Every precomposed Latin letter with its base letter."""
    accented, plain = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(code))
        base = "".join(p for p in parts if not unicodedata.combining(p))
        if len(parts) > 1 and len(base) == 1:
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_tables()
_NAMED_REFERENCES = json.dumps({name: chr(code) for name, code in name2codepoint.items()})


def decode_entities(c) -> Column:
    """Named and numeric character references to characters."""
    c = _column(c)
    named = F.from_json(F.lit(_NAMED_REFERENCES), "map<string,string>")
    reference = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"

    def from_code(digits: Column, base: int) -> Column:
        return F.decode(F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0")), "UTF-32")

    def resolve(body: Column) -> Column:
        return (
            F.when(F.lower(F.substring(body, 1, 2)) == "#x", from_code(F.substring(body, 3, 8), 16))
            .when(F.substring(body, 1, 1) == "#", from_code(F.substring(body, 2, 10), 10))
            .otherwise(F.coalesce(named[body], F.concat(F.lit("&"), body, F.lit(";"))))
        )

    found = F.regexp_extract_all(c, F.lit(reference), F.lit(1))
    rest = F.split(c, reference, -1)
    joined = F.array_join(
        F.zip_with(rest, F.transform(found, resolve), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))),
        "",
    )
    return F.when(F.instr(c, "&") > 0, joined).otherwise(c)


def strip_html(c) -> Column:
    """Text of an HTML fragment: no scripts, styles, comments or tags."""
    c = _column(c)
    hidden = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<![^>]*>"
    plain = F.regexp_replace(F.regexp_replace(c, hidden, ""), r"(?s)<[^>]+>", "")
    return F.transform(F.array(plain), decode_entities)[0]  # worked out once, however often it is used


def find_urls(c) -> Column:
    return F.regexp_extract_all(_column(c), F.lit(f"({URL_PATTERN})"), F.lit(1))


def drop_urls(c) -> Column:
    return F.regexp_replace(_column(c), URL_PATTERN, "")


def clean_word(c) -> Column:
    kept = F.btrim(F.regexp_replace(_column(c), NOT_WORD_LETTERS, ""), F.lit(" \n"))
    return F.regexp_replace(F.lower(kept), ASCII_PUNCTUATION, "")


def letters_only(words) -> Column:
    """Keep letters and spaces of each word; drop empties and repeats."""
    cleaned = F.transform(_column(words), lambda w: F.regexp_replace(w, NOT_LETTERS_OR_SPACE, ""))
    return F.array_distinct(F.filter(cleaned, lambda w: w != ""))


def longer_than(words, size: int) -> Column:
    return F.filter(_column(words), lambda w: F.length(w) > size)


def fold_accents(c) -> Column:
    plain = F.translate(F.lower(_column(c)), _ACCENTED, _PLAIN)
    return F.regexp_replace(plain, r"\p{Mn}+", "")


def squeeze_name(c) -> Column:
    """Folded name without spaces."""
    return F.replace(fold_accents(c), F.lit(" "), F.lit(""))


def host_name(url) -> Column:
    """Address after the scheme and leading w's, slashes removed."""
    url = _column(url)
    prefix = F.length(F.regexp_extract(url, HOST_PREFIX, 0))
    return F.replace(F.substr(url, prefix + 1), F.lit("/"), F.lit(""))


def before_first_dot(c) -> Column:
    return F.split(_column(c), r"\.")[0]


def bare_words(c) -> Column:
    """Lower-case text without ASCII punctuation, its white space turned to blanks."""
    return F.translate(F.lower(_column(c)), WHITESPACE + PUNCTUATION, " " * len(WHITESPACE))


def corpus_tokens(c) -> Column:
    """Lower-case words with ASCII punctuation removed.

    One pass turns white space to blanks and deletes punctuation, so the split
    needs no pattern.
    """
    return F.array_remove(F.split(bare_words(c), " "), "")


def title_tokens(c) -> Column:
    """Words of a title, case kept; inner hyphens, dots and quotes stay."""
    return F.regexp_extract_all(
        _column(c), F.lit(r"([\p{L}\p{N}]+(?:[-'.][\p{L}\p{N}]+)*)"), F.lit(1)
    )


def first_sentence(c) -> Column:
    return F.split(_column(c), r"\. ")[0]


def publication_variants(name) -> Column:
    """Spellings to look up, in rule order: a later match wins."""
    name = _column(name)
    words = F.split(name, " ")
    shorter = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    long_enough = F.length(name) > 3
    parts = [F.transform(F.split(name, rf"\Q{s}\E"), F.lower) for s in NAME_SEPARATORS]
    return F.concat(
        F.array(F.lower(name)),
        *parts,
        F.array(fold_accents(name), squeeze_name(name)),
        F.when(
            long_enough,
            F.array(F.lower(F.array_join(shorter, "")), F.lower(F.array_join(shorter, " "))),
        ).otherwise(F.array().cast("array<string>")),
        F.array(before_first_dot(name)),
    )


def registry_keys(name, url) -> Column:
    """Spellings under which a registered outlet is known."""
    host = host_name(url)
    return F.array(F.lower(_column(name)), host, before_first_dot(host), fold_accents(name), squeeze_name(name))


def parse_count(c, *suffixes: str) -> Column:
    """Integer from a counter text after dropping words such as 'clics' or 'K '."""
    c = _column(c)
    for s in suffixes:
        c = F.replace(c, F.lit(s), F.lit(""))
    return F.btrim(c).try_cast("bigint")


def capitalised_runs(c) -> Column:
    """Runs of capitalised words, joined by single spaces."""
    return F.regexp_extract_all(_column(c), F.lit(r"(\p{Lu}\p{L}+(?: \p{Lu}\p{L}+)*)"), F.lit(1))
