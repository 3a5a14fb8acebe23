"""Name keys: two folding rules, aliases, variants and rule lookups.

The group rule and the entity rule differ on purpose. The group rule lets letters
without a plain form become separators; the entity rule spells some of them out
first. They must never share one key.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from tallyweave import constants as K
from tallyweave.functions.numbers import as_col, strip

# Latin letters, phonetic and extended Latin letters, and their compatibility forms:
# super- and subscripts, letter-like symbols, number forms, enclosed, ligature and wide forms.
_BLOCKS = [
    (0x80, 0x370), (0x1AB0, 0x1B00), (0x1D00, 0x1F00), (0x2070, 0x20A0), (0x20D0, 0x2190), (0x2460, 0x2500),
    (0x2C60, 0x2C80), (0xA720, 0xA800), (0xAB30, 0xAB70), (0xFB00, 0xFB07), (0xFE20, 0xFE30), (0xFF00, 0xFFF0),
]


def _plain(text: str) -> str:
    parts = unicodedata.normalize("NFKD", text.casefold())
    return "".join(ch for ch in parts if not unicodedata.combining(ch))


@lru_cache(maxsize=1)
def accent_rule() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(letters, their plain letters then deletions, letters with longer plain forms).

    Worked out from the Unicode decomposition of each letter in the Latin blocks.
    """
    single, deleted, longer = [], [], []
    for first, stop in _BLOCKS:
        for ch in map(chr, range(first, stop)):
            plain = _plain(ch)
            if plain == ch or ch != ch.lower():
                continue  # text is put in lower case first
            if len(plain) == 1:
                single.append((ch, plain))
            elif plain == "":
                deleted.append(ch)
            elif any(p.isascii() and p.isalnum() for p in plain):
                longer.append((ch, plain))
    letters = "".join(a for a, _ in single) + "".join(deleted)
    return letters, "".join(b for _, b in single), tuple(longer)


def remove_accents(c: Column) -> Column:
    """Latin letters to their plain lower-case form, combining marks dropped.

    Text with as many bytes as characters is plain already and skips the letter table.
    """
    letters, plain, longer = accent_rule()
    low = F.lower(c)
    # Letters with a longer form take one replacement for each that the text holds, not one for each there is.
    # A class of all of them would be tried letter by letter at each character; outside ASCII is one comparison.
    forms = F.create_map(*[F.lit(v) for pair in longer for v in pair])
    held = F.array_distinct(F.regexp_extract_all(low, F.lit(r"([^\x00-\x7F])"), F.lit(1)))
    text = F.aggregate(
        F.filter(held, lambda letter: F.map_contains_key(forms, letter)),
        low,
        lambda text, letter: F.replace(text, letter, F.element_at(forms, letter)),
    )
    return F.when(F.octet_length(low) == F.char_length(low), low).otherwise(F.translate(text, letters, plain))


@F.pandas_udf(T.StringType())
def _remove_accents_exact(s: pd.Series) -> pd.Series:
    return s.map(_plain, na_action="ignore")


def _words(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def fold_key(c: Column | str, exact: bool = False) -> Column:
    """Group-name key: case, accents, dashes and punctuation do not count.

    ``exact`` covers every character through Python's Unicode tables in Arrow batches;
    the default covers Latin letters and their compatibility forms inside the JVM.
    """
    text = as_col(c)
    return _words(_remove_accents_exact(text) if exact else remove_accents(text))


def fold_name(
    c: Column | str,
    stop_tokens: Sequence[str] = K.STOP_TOKENS,
    transliteration: Sequence[tuple[str, str]] = K.TRANSLITERATION,
    exact: bool = False,
) -> Column:
    """Entity-name key: listed letters are spelled out, listed tokens dropped."""
    text = F.lower(as_col(c))
    for source, target in transliteration:
        text = F.replace(text, F.lit(source), F.lit(target))
    text = _remove_accents_exact(text) if exact else remove_accents(text)
    if stop_tokens:
        edge = r"[\p{L}\p{N}_]"
        # Most characters begin no token; looking behind them is left out.
        first = f"(?=[{''.join(sorted({t[0] for t in stop_tokens}))}])" if all(t.isalnum() for t in stop_tokens) else ""
        text = F.regexp_replace(text, f"{first}(?<!{edge})({'|'.join(stop_tokens)})(?!{edge})", " ")
    return _words(text)


def alias_name(folded: Column | str, prefixes: Sequence[tuple[str, str]] = K.ALIAS_PREFIXES) -> Column:
    """Ordered prefix rewrites on a folded name."""
    text = as_col(folded)
    for source, target in prefixes:
        text = F.regexp_replace(text, f"^{source}", target)
    return F.btrim(F.regexp_replace(text, r"\s+", " "))


def without_parentheses(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), r"\([^)]*\)", " ")


def name_variants(
    c: Column | str,
    prefixes: Sequence[tuple[str, str]] = K.ALIAS_PREFIXES,
    stop_tokens: Sequence[str] = K.STOP_TOKENS,
    place_pattern: str = K.PLACE_PATTERN,
    place_heads: Sequence[str] = K.PLACE_HEADS,
    place_prefix: str = K.PLACE_PREFIX,
) -> Column:
    """Sorted distinct folded spellings of a name.

    Folded, without parentheses, each part of a slash form, the alias of each of
    these, and a later part's bare head word joined to the place of the first part.
    """

    def variants(folded: Column) -> Column:
        # Places 0 and 1 hold the whole name and the cleaned one, the rest its parts.
        parts = F.slice(folded, 3, F.greatest(F.size(folded) - 2, F.lit(0)))
        later = F.slice(folded, 4, F.greatest(F.size(folded) - 3, F.lit(0)))
        place = F.regexp_extract(F.coalesce(F.get(parts, 0), F.lit("")), place_pattern, 1)
        carried = F.when(
            (place != "") & F.exists(later, lambda p: p.isin(list(place_heads))),
            F.array(F.concat(F.lit(f"{place_prefix} "), place)),
        ).otherwise(F.array().cast("array<string>"))
        every = F.concat(folded, F.transform(folded, lambda p: alias_name(p, prefixes)), carried)
        return F.array_sort(F.filter(F.array_distinct(every), lambda p: p != ""))

    name, cleaned = as_col(c), without_parentheses(c)
    parts = F.when(
        F.contains(cleaned, F.lit("/")),
        F.filter(F.transform(F.split(cleaned, "/"), strip), lambda p: p != ""),
    ).otherwise(F.array().cast("array<string>"))
    pieces = F.concat(F.array(name, cleaned), parts)
    # Folding sits in one lambda and its result is bound to another, so it is
    # planned and evaluated once for all uses.
    folded = F.transform(pieces, lambda p: fold_name(p, stop_tokens))
    return F.get(F.transform(F.array(folded), variants), 0)


def contains_hint(folded: Column | str, rules: Sequence[tuple[str, str]] = K.LOCATION_HINTS) -> Column:
    """Value of the first rule whose token occurs in the folded name, else NULL."""
    if not rules:
        return F.lit(None).cast("string")
    text, chain = as_col(folded), None
    for token, value in rules:
        hit = F.contains(text, F.lit(token))
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return chain


def is_group_or_total(
    folded: Column | str,
    names: Sequence[str] = K.TOTAL_NAMES,
    literal: Column | None = None,
    literals: Sequence[str] = (),
    row_type: Column | None = None,
    aggregate_type: str = "aggregate",
) -> Column:
    """True for total and small-group rows by folded name, literal name or row type."""
    flag = F.coalesce(as_col(folded).isin(list(names)), F.lit(False))
    if literal is not None and literals:
        flag = flag | F.coalesce(literal.isin(list(literals)), F.lit(False))
    if row_type is not None:
        flag = flag | F.coalesce(row_type == aggregate_type, F.lit(False))
    return flag


def is_small_group(labels: Sequence[str], *columns: Column | str) -> Column:
    """True where the entity or its parent carries a "fewer than" label."""
    flag = F.lit(False)
    for c in columns:
        flag = flag | F.coalesce(as_col(c).isin(list(labels)), F.lit(False))
    return flag


def priority_class(status: Column | str, required: Column, excluded: str = K.EXCLUDED) -> Column:
    """Excluded, required or reference-only, from the match status and presence flags."""
    return (
        F.when(as_col(status) == excluded, F.lit(K.EXCLUDED))
        .when(required, F.lit(K.REQUIRED))
        .otherwise(F.lit(K.REFERENCE_ONLY))
    )
