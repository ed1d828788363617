"""Scalar text functions as Column expressions; all but NFKC stay inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space, spelt out: the engines' own ``\s`` differ.
WS_CHARS = r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{WS_CHARS}]"
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WS_NO_LF = WS.replace(r"\x{9}-\x{D}", r"\x{9}\x{B}-\x{D}")
#: Line ends as Python's ``splitlines`` takes them.
LINE_END = r"\r\n|[\n\r\x{B}\x{C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
CONTROL = r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}]"

#: Lower-case phrases by which a reply declines to answer.
REFUSALS = (
    "as an ai", "抱歉，我无法", "i am unable to", "由于系统限制", "i'm unable to", "作为人工智能", "i can't answer",
    "我不能回答", "i cannot answer", "as an ai language model", "我无法回答",
)
CODE_HEADS = ("#include", "const ", "let ", "var ", "function ", "class ", "def ", "import ", "from ")


def as_text(c: Column) -> Column:
    """Null becomes the empty string, other types their string form."""
    return F.coalesce(c.cast("string"), F.lit(""))


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility normalisation; Spark has no expression for it."""
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once a row: an expression inside a lambda is worked out for each element."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def tidy_lines(c: Column) -> Column:
    """CR and CRLF to LF, every line right-stripped, the whole stripped.

    A run of white space is looked at from its start alone, so long runs inside a line cost no more than others."""
    lf = F.regexp_replace(c, r"\r\n?", "\n")
    return strip(F.regexp_replace(lf, f"(?<!{WS_NO_LF}){WS_NO_LF}++(?=\n)", ""))


def normalize_text(c: Column, compatibility: bool = True) -> Column:
    return tidy_lines(nfkc(c) if compatibility else c)


def dedupe_paragraphs(c: Column) -> Column:
    """Drops a paragraph that repeats its predecessor up to white space; paragraphs are parted by a blank line."""
    parts = F.filter(F.transform(F.split(c, "\n\n"), strip), lambda p: p != "")
    key = lambda p: F.regexp_replace(p, f"{WS}+", " ")
    pairs = F.arrays_zip(parts.alias("p"), F.concat(F.array(F.lit(None).cast("string")), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("b"))
    kept = F.filter(pairs, lambda x: F.coalesce(key(x["p"]) != key(x["b"]), F.lit(True)))
    return F.array_join(F.transform(kept, lambda x: x["p"]), "\n\n")


def punctuation_count(c: Column) -> Column:
    """Code points that are neither letters or numbers nor white space; combining marks count."""
    return F.regexp_count(c, F.lit(rf"[^\p{{L}}\p{{N}}{WS_CHARS}]"))


def ratio(count: Column, c: Column) -> Column:
    return F.when(F.length(c) == 0, 0.0).otherwise(count.cast("double") / F.length(c))


def punctuation_ratio(c: Column) -> Column:
    return ratio(punctuation_count(c), c)


def non_printable_ratio(c: Column) -> Column:
    return ratio(F.regexp_count(c, F.lit(CONTROL)), c)


def length_bounds(c: Column, least: int, most: int | None, truncate: bool = True) -> Column:
    """Null below ``least``; beyond ``most`` cut, or null if not to be cut."""
    out = c if most is None else F.when(F.length(c) > most, F.substring(c, 1, most) if truncate else F.lit(None)).otherwise(c)
    return F.when(F.length(c) >= least, out)


def replace_markers(c: Column, markers: Mapping[str, str]) -> Column:
    """Literal replacements one after another; later ones see what earlier ones wrote."""
    for old, new in markers.items():
        if old:
            c = F.replace(c, F.lit(old), F.lit(new))
    return c


def fingerprint(c: Column, algorithm: str = "sha1") -> Column:
    """Hex digest; any name but md5 means sha1."""
    return F.md5(c.cast("binary")) if algorithm == "md5" else F.sha1(c.cast("binary"))


def words(c: Column) -> Column:
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def shingles(w: Column, n: int = 5) -> Column:
    """Word n-grams of a column of lower-case words; fewer words are one shingle, none have none.

    ``w`` should be a column of its own, not an expression: it is looked up once per shingle."""
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) >= n, grams).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))


def looks_structured(c: Column) -> Column:
    """Code or table: many brackets, indented lines, several lines that open like code, or tabs."""
    lines = F.split(F.regexp_replace(c, f"({LINE_END})$", ""), LINE_END)
    head = F.slice(lines, 1, 80)
    indented = F.size(F.filter(head, lambda x: x.startswith("    ") | x.startswith("\t")))
    left = F.transform(F.slice(lines, 1, 40), lambda x: F.regexp_replace(x, f"^{WS}+", ""))
    any_head = lambda x: F.exists(F.array(*map(F.lit, CODE_HEADS)), lambda k: F.startswith(x, k))
    tabs = F.regexp_count(c, F.lit("\t"))
    return (F.length(c) > 0) & (
        (ratio(F.regexp_count(c, F.lit(r"[{}\[\]();<>`]")), c) > 0.015)
        | (indented > 0.25 * F.size(head))
        | (F.size(F.filter(left, any_head)) >= 2)
        | ((tabs > 5) & (F.instr(F.substring(c, 1, 200), "\t") > 0))
    )


def looks_like_refusal(c: Column, extra: Iterable[str] = ()) -> Column:
    low = F.lower(strip(as_text(c)))
    hits = [F.contains(low, F.lit(s.lower())) for s in (*REFUSALS, *extra)]
    return (low != "") & F.array_contains(F.array(*hits), True)


def lang_matches(candidate: Column, allowed: Column) -> Column:
    """Equal after folding, both Chinese, or the same first two letters."""
    fold = lambda x: F.replace(F.lower(x), F.lit("_"), F.lit("-"))
    a, b = fold(candidate), fold(allowed)
    return (a == b) | (a.startswith("zh") & b.startswith("zh")) | (F.substring(a, 1, 2) == F.substring(b, 1, 2))


def strip_fences(c: Column) -> Column:
    return strip(F.regexp_replace(strip(c), f"(?md)^```(?:json)?{WS}*|{WS}*```$", ""))


def drop_trailing_commas(c: Column) -> Column:
    return F.regexp_replace(c, rf",({WS}*[\]}}])", "$1")


def flatten_newlines(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit("\\n"))


def first_balanced_object(c: Column) -> Column:
    """From the first opening brace to where braces balance, quotes not looked at; null if they never do."""
    at = F.instr(c, "{")
    chars = F.split(F.substr(c, at), "")
    state = F.aggregate(
        chars, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("done")),
        lambda s, x: F.when(s["done"], s).otherwise(
            F.struct(
                (s["depth"] + F.when(x == "{", 1).when(x == "}", -1).otherwise(0)).alias("depth"),
                (s["n"] + 1).alias("n"),
                ((x == "}") & (s["depth"] == 1)).alias("done"),
            )
        ),
    )
    return F.when((at > 0) & state["done"], F.substr(c, at, state["n"]))
