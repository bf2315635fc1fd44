"""String Column builders. All JVM-side built-ins; no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

# --- fixed patterns ---
TOKEN_PATTERN = r"\(([^()]*)\)\s*$"  # last parenthesised text at the end
ISIN_PATTERN = r"\A[A-Z0-9]{12}\z"  # full match, no trailing newline
SYMBOL_IN_PARENS_PATTERN = r"\(([A-Za-z0-9._\-]+)\)\s*$"
TRAILING_WORD_PATTERN = r"([A-Za-z0-9._\-]{2,})$"
STOCK_NAME_DISALLOWED = r"[^A-Za-z0-9\s.,&()\-]"
DISPLAY_SYMBOL_SUFFIX = r"\s*\(([A-Z0-9.\-:]{2,20})\)\s*$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip leading/trailing whitespace (not only spaces)."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def upper_trim(c: Column | str) -> Column:
    """C1 SQL form: UPPER(TRIM(x)) (spaces)."""
    return F.upper(F.trim(col_(c)))


def upper_strip(c: Column | str) -> Column:
    """C1 dataframe form: strip all whitespace, then upper."""
    return F.upper(strip_ws(c))


def norm_code(c: Column | str, default: str = "") -> Column:
    """Null -> default, strip, upper (ticker / name normalisation)."""
    return F.upper(strip_ws(F.coalesce(col_(c), F.lit(default))))


def blank_to_null(c: Column | str) -> Column:
    """C9: '' -> null."""
    return F.nullif(col_(c), F.lit(""))


def non_blank(c: Column | str) -> Column:
    """P5: non-null and TRIM(x) <> ''."""
    return col_(c).isNotNull() & (F.trim(col_(c)) != "")


def extract_token(c: Column | str) -> Column:
    """Last trailing "(...)" text, trimmed and upper-cased; '' -> null."""
    tok = F.regexp_extract(strip_ws(c), TOKEN_PATTERN, 1)
    matched = strip_ws(c).rlike(TOKEN_PATTERN)
    return F.when(matched, F.nullif(F.upper(strip_ws(tok)), F.lit("")))


def token_isin(token: Column | str) -> Column:
    """Drop spaces; keep only a 12-character [A-Z0-9] code."""
    clean = F.replace(col_(token), F.lit(" "), F.lit(""))
    return F.when(F.coalesce(clean, F.lit("")).rlike(ISIN_PATTERN), clean)


def extract_symbol(name: Column | str, fallback: Column | str | None = None) -> Column:
    """C4: fallback (upper) if non-blank, else "(SYM)" at the end, else a
    trailing word of two or more characters."""
    n = col_(name)
    in_parens = F.when(n.rlike(SYMBOL_IN_PARENS_PATTERN), F.upper(F.regexp_extract(n, SYMBOL_IN_PARENS_PATTERN, 1)))
    trailing = F.when(
        F.trim(n).rlike(TRAILING_WORD_PATTERN), F.upper(F.regexp_extract(F.trim(n), TRAILING_WORD_PATTERN, 1))
    )
    from_name = F.when(n.isNotNull() & (n != ""), F.coalesce(in_parens, trailing))
    if fallback is None:
        return from_name
    fb = col_(fallback)
    return F.when(non_blank(fb), F.upper(F.trim(fb))).otherwise(from_name)


def clean_stock_name(full_name: Column | str, symbol: Column | str) -> Column:
    """Drop a glued trailing symbol (case-sensitive), then characters
    outside [A-Za-z0-9 whitespace . , & ( ) -]; trim."""
    n = col_(full_name)
    s = strip_ws(col_(symbol))
    t = strip_ws(n)
    # a blank symbol "ends" every name and slicing by its zero length empties it
    body = (F.when(s == "", F.lit("")).when(t.endswith(s), strip_ws(F.left(t, F.length(t) - F.length(s))))
            .otherwise(t))
    cleaned = strip_ws(F.regexp_replace(body, STOCK_NAME_DISALLOWED, ""))
    return F.when(n.isNull() | (n == "") | col_(symbol).isNull() | (col_(symbol) == ""), n).otherwise(cleaned)


def normalize_ticker(c: Column | str) -> Column:
    """upper(trim(x)), part before ':'; null -> ''."""
    t = F.upper(strip_ws(F.coalesce(col_(c), F.lit(""))))
    return F.split_part(t, F.lit(":"), F.lit(1))


def clean_holding_name(name: Column | str, ticker: Column | str) -> Column:
    """Drop a glued ticker suffix (case-blind), drop a trailing
    "(SYMBOL)", squeeze runs of whitespace. Null name -> ''."""
    s = strip_ws(F.coalesce(col_(name), F.lit("")))
    t = strip_ws(F.coalesce(col_(ticker), F.lit("")))
    glued = (F.length(t) > 0) & F.upper(s).endswith(F.upper(t))
    s1 = F.when(glued, strip_ws(F.left(s, F.length(s) - F.length(t)))).otherwise(s)
    s2 = strip_ws(F.regexp_replace(s1, DISPLAY_SYMBOL_SUFFIX, ""))
    return F.regexp_replace(s2, r"\s{2,}", " ")


def holding_key(ticker_norm: Column | str, name_norm: Column | str) -> Column:
    """Normalised ticker, else normalised name."""
    return F.when(col_(ticker_norm) != "", col_(ticker_norm)).otherwise(col_(name_norm))


def is_country_label(c: Column | str) -> Column:
    """False if blank, a region-like value, or containing a region
    token (all case-sensitive); else true."""
    v = strip_ws(c)
    token_hit = F.lit(False)
    for tok in config.REGION_LIKE_TOKENS:
        token_hit = token_hit | F.contains(v, F.lit(tok))
    res = ~(v.isin(*config.REGION_LIKE_VALUES)) & ~token_hit
    return F.when(col_(c).isNull() | (v == ""), F.lit(False)).otherwise(res)


def display_label(name: Column | str, ticker: Column | str) -> Column:
    """C11: "name (TICKER)" when a ticker exists; name, else ticker, else '-'."""
    n = col_(name)
    t = col_(ticker)
    label = F.when((n != "") & (t != ""), F.concat(n, F.lit(" ("), t, F.lit(")")))
    return F.coalesce(label, F.nullif(n, F.lit("")), F.nullif(t, F.lit("")), F.lit("-"))


def contains_ci(c: Column | str, q: str) -> Column:
    """Case-blind substring test; empty query keeps all."""
    q = q.strip().lower()
    if not q:
        return F.lit(True)
    return F.contains(F.lower(F.coalesce(col_(c).cast("string"), F.lit(""))), F.lit(q))
