from __future__ import annotations

import random
import re
import unicodedata

from pyspark.sql import functions as F

from corpusloom.functions import text as t


def values(spark, rows, *cols):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_normalise(spark):
    got = values(spark, ["ＡＢＣ\r\nline2  \rline3\t ", None, "", "  \n x \n\n"], t.normalize_text(F.col("s")))
    assert got == [("ABC\nline2\nline3",), (None,), ("",), ("x",)]


def test_white_space_is_pythons(spark):
    chars = [chr(c) for c in range(0x3100) if chr(c).isspace()] + ["a", "​", "é"]
    got = values(spark, [f"x{c}y" for c in chars], F.size(t.words(F.col("s"))))
    assert [n for (n,) in got] == [len(f"x{c}y".split()) for c in chars]


def test_paragraphs(spark):
    def plain(s):
        out, last = [], None
        for p in s.split("\n\n"):
            p = p.strip()
            key = " ".join(p.split())
            if p and key != last:
                out.append(p)
                last = key
        return "\n\n".join(out)

    rng = random.Random(1)
    rows = ["", "a\n\na", "a\n\nA", "a  b\n\na b\n\nc", "\n\n\n\nx"] + ["".join(rng.choice(["a", "b", "\n\n", " ", "\n"]) for _ in range(20)) for _ in range(60)]
    assert [x for (x,) in values(spark, rows, t.dedupe_paragraphs(F.col("s")))] == [plain(r) for r in rows]


def test_ratios_and_bounds(spark):
    got = values(spark, ["abc\x01def", "!!!???...", "ab", "abcdef", ""], t.non_printable_ratio(F.col("s")), t.punctuation_ratio(F.col("s")), t.length_bounds(F.col("s"), 3, 5), t.length_bounds(F.col("s"), 3, 5, False))
    assert got[0][0] == 1 / 7 and got[1][1] == 1.0 and got[4][:2] == (0.0, 0.0)
    assert [g[2] for g in got] == ["abc\x01d", "!!!??", None, "abcde", None] and got[3][3] is None


def test_punctuation_counts_marks(spark):
    rows = ["नमस्ते", "áb", "x_y-z", "٣ x"]
    want = [sum(not c.isalnum() and not c.isspace() for c in r) for r in rows]
    assert [n for (n,) in values(spark, rows, t.punctuation_count(F.col("s")))] == want
    assert any(unicodedata.category(c)[0] == "M" for c in rows[0])


def test_structured(spark):
    def plain(s):
        if not s:
            return False
        if sum(c in "{}[]();<>`" for c in s) / len(s) > 0.015:
            return True
        lines = s.splitlines()[:80]
        if sum(x.startswith(("    ", "\t")) for x in lines) / max(1, len(lines)) > 0.25:
            return True
        if sum(x.lstrip().startswith(t.CODE_HEADS) for x in lines[:40]) >= 2:
            return True
        return s.count("\t") > 5 and "\t" in s[:200]

    rows = ["", "word " * 40, "a;", "    x\ny", "x\n" * 5 + "    y", "import a\nfrom b c\nword word", "w\t" * 6, "w " * 150 + "\t" * 7, "def x\n\n", "\n\n"]
    assert [x for (x,) in values(spark, rows, t.looks_structured(F.col("s")))] == [plain(r) for r in rows]


def test_refusals_and_languages(spark):
    assert [x for (x,) in values(spark, ["I'm unable to do it", "  ", None, "fine", "作为人工智能助手"], t.looks_like_refusal(F.col("s")))] == [True, False, False, False, True]
    pairs = [("zh-cn", "zh_TW", True), ("en", "en-US", True), ("fr", "en", False), ("DE", "de", True)]
    df = spark.createDataFrame(pairs, "a string, b string, w boolean")
    assert all(r[0] == r[1] for r in df.select(t.lang_matches(F.col("a"), F.col("b")), "w").collect())


def test_shingles(spark):
    rows = ["", "a b", "a b c d e", "A b c d e f", "漢字文字列"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string").select("i", t.words(F.lower("s")).alias("w"))
    got = [r[1] for r in df.select("i", t.shingles(F.col("w"), 5)).orderBy("i").collect()]
    assert got == [[], ["a b"], ["a b c d e"], ["a b c d e", "b c d e f"], ["漢字文字列"]]


def test_balanced_object(spark):
    def plain(s):
        i = s.find("{")
        depth = 0
        for j in range(i, len(s)) if i >= 0 else ():
            depth += (s[j] == "{") - (s[j] == "}")
            if depth == 0:
                return s[i : j + 1]
        return None

    rng = random.Random(4)
    rows = ["", "x {a {b} c} d", "{", "}{", "{}{}"] + ["".join(rng.choice("{}ab") for _ in range(9)) for _ in range(80)]
    assert [x for (x,) in values(spark, rows, t.first_balanced_object(F.col("s")))] == [plain(r) for r in rows]


def test_fences_and_commas(spark):
    got = values(spark, ["```json\n[1,]\n```", " [1] ", "{\"a\": [1, 2, ], }"], t.strip_fences(F.col("s")), t.drop_trailing_commas(F.col("s")))
    assert got[0][0] == "[1,]" and got[1][0] == "[1]" and got[2][1] == '{"a": [1, 2 ] }'
    assert re.sub(r",(\s*[\]}])", r"\1", '{"a": [1, 2, ], }') == got[2][1]
