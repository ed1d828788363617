"""Exact token counts, of whole texts and of every prefix.

The counting unit is the piece of a text between two spaces, tabs or line ends.  The word BPE drops white
space, never merges across it and normalises each side of it on its own, so a piece's ids do not depend on
what is around it; they are computed once per distinct piece and kept in a cache bounded in pieces and in
their length.

Prefix dynamic programming.  For BPE the last token of a prefix decides the prefix's count:
``count[i] = count[i - len(t)] + 1`` for the one token t that ends at i and forms a valid pair with the
last token of ``prefix[:i - len(t)]`` (two tokens are a valid pair if encoding their concatenation gives
back these two).  One pass over a piece thus yields the exact count at each of its prefixes.  Two tables
run side by side, since a token at the end of a word carries the end-of-word mark and one inside doesn't.
Stored are the differences between neighbouring prefixes, one signed byte per code point, so any
truncation or budget question is a running sum over the store and never encodes again.

Pieces are cut at the pre-tokenizer's own boundaries.  Where normalisation is not one code point to one, or
a special string or a contraction is cut by a prefix, ``Walk`` takes the same steps code point by code
point, so time and memory stay in proportion to a piece's length whatever it holds.  The totals are also taken
from the library, as a check; where both differ, the library counts each prefix.

Defined results: null text counts as empty, with no tokens and an empty store; rows are counted one by one,
so repeated rows and ids, null ids and ties need no order; an empty table gives an empty result; very long
texts and pieces are counted whole.  Other columns are ignored by ``token_counts`` and pass through
``prefix_token_counts``, where a column of the name of a new one gives way to it.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import arrow_batches

BUDGET = 2048
CACHE_PIECES = 700_000
#: Longer pieces are rare and rarely repeat; they are not kept beyond their batch.
LONG_PIECE = 200
#: Printable ASCII: lower-casing and cutting need no look at Unicode.
SIMPLE = re.compile(r"[\x21-\x7e]*")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SEGMENT = re.compile("|".join(CONTRACTIONS) + r"|[a-z]+|[0-9]|[^a-z0-9]+")
#: ASCII marks that end a word without a look at what follows.
FINAL_MARKS = frozenset("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
MARKS = re.compile(r"([^\w\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+) ")
#: White space to the tokenizer; Python's own notion holds four controls more.
SPACE = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | {chr(c) for c in range(0x2000, 0x200B)}
#: Start of a prefix store of 32-bit differences.
WIDE = b"\x04wide"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Latin-1: spaces, marks, and the rest.
KINDS = bytes(32 if chr(c) in " \n\t\r" else 97 if chr(c) in SPACE or unicodedata.category(chr(c))[0] in "LN" else 46 for c in range(256))


class Pieces:
    """Ids and prefix counts of pieces of text, cached by piece; a full cache keeps what is in use.

    A new piece is cut into pre-tokens, and all new pre-tokens of a batch are encoded in one call of a
    tokenizer that holds the model alone.  A pre-token's last id carries the end-of-word mark, which tells
    where the next one begins.  Pieces that this cutting can't be trusted with (special strings, code
    points whose normalisation isn't one to one) go to the full tokenizer."""

    _made: dict[str, "Pieces"] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.path = path
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        bare = spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.specials = [t["content"] for t in spec["added_tokens"]]
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        self.alphabet = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.kinds: dict[str, tuple[str, str]] = {}
        self.ids: dict[str, bytes] = {"": b""}
        self.deltas: dict[str, bytes] = {"": b""}
        self.prefix = PrefixTable(spec["model"])
        self.wide: set[str] = set()
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.heads = {c: self._head(c) for c in CONTRACTIONS}

    @classmethod
    def get(cls, path: str) -> "Pieces":
        """One per Python worker: loading the vocabulary takes longer than many a task."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    @staticmethod
    def split(text: str) -> list[str]:
        """Pieces between spaces, tabs and line ends, one for each and one more.  Latin-1 text is lower-cased
        first, which there maps code points one to one and can't meet a combining mark, so fewer distinct pieces
        are left; a text that may hold a special string keeps its case."""
        if "<|" not in text:
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def _kind(self, c: str) -> tuple[str, str]:
        """Class (letter, number, other) and lower case of a code point; class '' if it can't be handled alone."""
        low, k = c.lower(), unicodedata.category(c)
        odd = len(low) != 1 or k[0] in "MZC" or c in SPACE or "\u1100" <= c <= "\u11ff" or unicodedata.normalize("NFC", c) != c
        self.kinds[c] = out = ("" if odd else k[0] if k[0] in "LN" else "S", low)
        return out

    def _head(self, contraction: str) -> list[int]:
        """Token counts of a contraction's prefixes: an apostrophe, letters after it, and the whole."""
        parts = [["'", contraction[1:k]] if k > 1 else ["'"] for k in range(1, len(contraction))] + [[contraction]]
        return [sum(len(x) // 2 for x in self.bulk(p)) for p in parts]

    def cut(self, piece: str) -> list[str] | None:
        """Lower-case pre-tokens of a piece, each code point in one of them; None: not to be cut here."""
        if SIMPLE.fullmatch(piece):
            return SEGMENT.findall(piece.lower()) if "<|" not in piece or not self.special.search(piece) else None
        if "'" in piece or "<|" in piece:
            return None
        kinds, out, before = self.kinds, [], ""
        for c in piece:
            k, low = kinds.get(c) or self._kind(c)
            if not k:
                return None
            if k == before != "N":
                out[-1] += low
            else:
                out.append(low)
            before = k
        return out

    def symbols(self, word: str) -> str:
        """A pre-token in the vocabulary's byte alphabet."""
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)

    def bulk(self, words: list[str], dtype: str = "<u2") -> list[bytes]:
        """Ids of each pre-token."""
        out: list[bytes] = []
        width = np.dtype(dtype).itemsize
        for lo in range(0, len(words), 2000):
            part = words[lo : lo + 2000]
            ids = np.asarray(self.bare.encode_batch_fast([" ".join(map(self.symbols, part))], add_special_tokens=False)[0].ids, np.uint32)
            at = ((np.flatnonzero(self.ends[ids]) + 1) * width).tolist()
            if len(at) != len(part):
                raise ValueError("the tokenizer's words don't match the pre-tokens given")
            raw = ids.astype(dtype).tobytes()
            out.extend([raw[a:b] for a, b in zip([0, *at], at)])
        return out

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _new(self, known: dict[str, bytes], texts: list[list[str]]) -> list[str]:
        now = set().union(*texts)
        new = now.difference(known)
        if len(known) + len(new) > CACHE_PIECES:  # what this batch uses stays, the rest goes
            kept = {p: known[p] for p in now.difference(new)}
            known.clear()
            known.update(kept)
            known[""] = b""
        return list(new)

    @staticmethod
    def pieces(text: str) -> list[str]:
        """As ``split``, with marks that end a piece made a piece of its own: after a letter or a number a run of
        marks is a pre-token, and elsewhere the cut falls on white space.  So fewer distinct pieces are left.
        Where no run is longer than one mark, plain replacement does."""
        if "<|" in text:
            return Pieces.split(text)
        try:
            kinds = text.encode("latin-1").translate(KINDS)
        except UnicodeEncodeError:
            return Pieces.split(text)
        text = text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ")
        if b".. " not in kinds:
            for m in ",.;:!?)":
                if m in text:
                    text = text.replace(m + " ", f" {m} ")
        elif "_" not in text:  # a mark to the tokenizer, not to the pattern
            text = MARKS.sub(r" \1 ", text)
        return text.split(" ")

    def _forget(self, known: dict[str, bytes], new: list[str]) -> None:
        if max(map(len, new), default=0) > LONG_PIECE:
            for p in new:
                if len(p) > LONG_PIECE:
                    known.pop(p, None)
                    self.wide.discard(p)

    def id_bytes(self, texts: list[str], dtype: str = "<u2") -> list[bytes]:
        """The ids of each text, little-endian."""
        split = [self.pieces(t) for t in texts]
        ids = self.ids
        words, cuts, odd = set(), [], []
        new = self._new(ids, split)
        for p in new:
            if p.isalpha():
                if p.islower() and (p.isascii() or max(p) < "\u0100"):
                    words.add(p)
                    continue
            elif p[-1] in FINAL_MARKS:
                w = p[:-1]
                if w.isalpha() and w.islower() and (w.isascii() or max(w) < "\u0100"):
                    words.add(w)
                    words.add(p[-1])
                    cuts.append((p, (w, p[-1])))
                    continue
            c = self.cut(p)
            if c is None:
                odd.append(p)
            else:
                cuts.append((p, c))
                words.update(c)
        # a pre-token is a piece too, so both share the cache
        unknown = list(words.difference(ids))
        ids.update(zip(unknown, self.bulk(unknown, dtype)))
        get = ids.__getitem__
        for p, c in cuts:
            if len(c) != 1 or c[0] != p:
                ids[p] = b"".join(map(get, c))
        for p, e in zip(odd, self.encode(odd)):
            ids[p] = np.asarray(e, dtype).tobytes()
        out = [b"".join(map(get, s)) for s in split]
        self._forget(ids, new)
        self._forget(ids, unknown)
        return out

    def _learn_deltas(self, split: list[list[str]]) -> list[str]:
        cuts, odd, doubted = [], [], set()
        new = self._new(self.deltas, split)
        for p in new:
            c = self.cut(p)
            odd.append(p) if c is None else cuts.append((p, c))
        words = sorted({w for _, c in cuts for w in c}.difference(self.heads))
        table = dict(zip(words, self.prefix.all_counts([self.symbols(w) for w in words])))
        short: dict[str, list[int]] = dict(self.heads)
        for w, i in zip(words, self.bulk(words)):
            c = table[w]
            if not w.isascii():  # counts at code points' ends
                at = np.cumsum([len(x.encode()) for x in w])
                c = [c[k - 1] for k in at]
            if c[-1] * 2 == len(i):
                short[w] = c
        for p, c in cuts:
            out = []
            for w in c:
                n = short.get(w)
                if n is None:
                    doubted.add(p)
                    break
                out.append(n[0])
                out.extend(map(int.__sub__, n[1:], n))
            else:
                self._store(p, out)
        for p, e in zip(odd, self.encode(odd)):
            n = Walk(self).counts(p)
            if n[-1] == len(e):
                self._store(p, np.diff(n, prepend=0).tolist())
            else:
                doubted.add(p)
        for p in doubted:
            n = [len(e) for e in self.encode([p[:k] for k in range(1, len(p) + 1)])]
            self._store(p, [b - a for a, b in zip([0, *n], n)])
        return new

    def _store(self, piece: str, deltas: list[int]) -> None:
        try:
            self.deltas[piece] = array("b", deltas).tobytes()
            if deltas and max(deltas) > 118:
                raise OverflowError
        except OverflowError:
            self.wide.add(piece)
            self.deltas[piece] = WIDE + np.asarray(deltas, "<i4").tobytes()

    def prefix_deltas(self, texts: list[str]) -> list[bytes]:
        """For each text, the change of its token count from each prefix to the next, a signed byte each
        (see ``unpack`` for the rare wider form)."""
        split = [self.split(t) for t in texts]
        new = self._learn_deltas(split)
        get = self.deltas.__getitem__
        out = []
        for s in split:
            if self.wide and not self.wide.isdisjoint(s):
                space = np.zeros(1, "<i4")
                arrays = [x for p in s for x in (unpack(get(p)), space)][:-1]
                out.append(WIDE + np.concatenate(arrays).astype("<i4").tobytes())
            else:
                out.append(b"\x00".join(map(get, s)))
        self._forget(self.deltas, new)
        return out


def unpack(store: bytes) -> np.ndarray:
    """Differences of a prefix store.  A store that starts with 4 and 'wide' holds 32-bit numbers; as
    signed bytes that start would need a count to rise by 119 at one code point."""
    if store[:5] == WIDE:
        return np.frombuffer(store, "<i4", offset=5)
    return np.frombuffer(store, np.int8)


def counts(store: bytes) -> np.ndarray:
    """Token counts of all prefixes: entry k is that of the first k code points."""
    return np.concatenate([[0], np.cumsum(unpack(store), dtype=np.int64)])


def longest_within(store: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts(store) <= budget)[-1])


class PrefixTable:
    """Counts at every prefix of a pre-token, by dynamic programming over the vocabulary."""

    def __init__(self, model: dict):
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        vocab = model["vocab"]
        self.inner = {t for t in vocab if not t.endswith("</w>")}
        self.final = {t[:-4] for t in vocab if t.endswith("</w>")}
        self.longest = max(map(len, vocab))
        self.pair: dict[tuple[str, str], bool] = {}
        self.pair_end: dict[tuple[str, str], bool] = {}

    def _bpe(self, s: str, end: bool) -> list[str]:
        parts = list(s)
        if end:
            parts[-1] += "</w>"
        rank = self.rank
        while len(parts) > 1:
            ranks = [rank.get(m, 1 << 60) for m in zip(parts, parts[1:])]
            low = min(ranks)
            if low == 1 << 60:
                break
            i = ranks.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _fits(self, left: str, right: str, end: bool) -> bool:
        """Whether encoding the two tokens' text gives back just these two."""
        return self._bpe(left + right, end) == ([left] if left else []) + [right + "</w>" * end]

    def all_counts(self, words: list[str]) -> list[list[int]]:
        """For each word, given in order, the token count of each of its prefixes.  A word goes on from
        the states that it shares with the word before it."""
        inner, final, pair, pair_end, longest = self.inner, self.final, self.pair, self.pair_end, self.longest
        if len(pair) + len(pair_end) > 3_000_000:
            pair.clear()
            pair_end.clear()
        last, n, out, before, result = [""], [0], [], "", []
        for s in words:
            m = min(len(s), len(before))
            i = 0
            while i < m and s[i] == before[i]:
                i += 1
            del last[i + 1 :], n[i + 1 :], out[i:]
            for e in range(i + 1, len(s) + 1):
                open_, closed = True, True
                for j in range(e - longest if e > longest else 0, e):
                    t = s[j:e]
                    if closed and t in final:
                        key = (last[j], t)
                        ok = pair_end.get(key)
                        if ok is None:
                            ok = pair_end[key] = self._fits(*key, True)
                        if ok:
                            out.append(n[j] + 1)
                            closed = False
                            if not open_:
                                break
                    if open_ and t in inner:
                        key = (last[j], t)
                        ok = pair.get(key)
                        if ok is None:
                            ok = pair[key] = self._fits(*key, False)
                        if ok:
                            found = (t, n[j] + 1)
                            open_ = False
                            if not closed:
                                break
                last.append(found[0])
                n.append(found[1])
            before = s
            result.append(out[:])
        return result

    def extend(self, run: "Run") -> None:
        """The states of a pre-token given symbol by symbol, after one more symbol."""
        e, found, closed = len(run.symbols), None, False
        for j in range(max(0, e - self.longest), e):
            t = "".join(run.symbols[j:e])
            if not closed and t in self.final and self._known(self.pair_end, run.last[j], t, True):
                run.out.append(run.n[j] + 1)
                closed = True
            if not found and t in self.inner and self._known(self.pair, run.last[j], t, False):
                found = (t, run.n[j] + 1)
            if closed and found:
                break
        run.last.append(found[0])
        run.n.append(found[1])

    def _known(self, table: dict[tuple[str, str], bool], left: str, right: str, end: bool) -> bool:
        ok = table.get((left, right))
        if ok is None:
            ok = table[left, right] = self._fits(left, right, end)
        return ok


class Run:
    """A pre-token in the making: its symbols and, after each, the last open token, its number and the count of the
    pre-token if it ended there."""

    def __init__(self) -> None:
        self.symbols: list[str] = []
        self.last, self.n, self.out = [""], [0], []

    def cut(self, size: int) -> None:
        del self.symbols[size:], self.last[size + 1 :], self.n[size + 1 :], self.out[size:]


class Walk:
    """Token counts at each prefix of a piece of any kind, code point by code point.

    A prefix may end inside a character that is composed of several code points, inside a contraction or
    inside a special string; what was counted there is taken back when the next code point changes it."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._open("")

    def _open(self, kind: str, done: int = 0) -> None:
        # kind: of the pre-token in the making; lead: apostrophe and letter that may become a contraction
        self.done, self.kind, self.run, self.lead = done, kind, Run(), ""

    def count(self) -> int:
        return self.done + (self.run.out[-1] if self.run.out else 0)

    def _state(self) -> tuple:
        return self.done, self.kind, self.run, self.lead, len(self.run.symbols)

    def _back(self, state: tuple) -> None:
        self.done, self.kind, self.run, self.lead, size = state
        self.run.cut(size)

    def _add(self, c: str) -> None:
        for x in c.encode().decode("latin-1").translate(self.pieces.alphabet):
            self.run.symbols.append(x)
            self.pieces.prefix.extend(self.run)

    def push(self, c: str) -> None:
        """One code point of normalised text."""
        k = unicodedata.category(c)[0]
        k = "W" if c in SPACE else k if k in "LN" else "S"
        if k == "L" and self.kind == "S" and self.run.symbols == ["'"] and c in "stmdrvl":
            if c in "stmd":
                self._add(c)
                self.kind = "C"
                return
            self._open("L", self.count())
            self._add(c)
            self.lead = "'" + c
            return
        if self.lead and self.lead + c in CONTRACTIONS:
            whole, done = self.lead + c, self.done - self.pieces.heads[self.lead + c][0]
            self._open("C", done)
            for x in whole:
                self._add(x)
            return
        if k != self.kind or k == "N":
            self._open(k, self.count())
        self.lead = ""
        if k != "W":
            self._add(c)

    def _plain(self, text: str) -> list[int]:
        """Counts at the prefixes of a text whose special strings, if any, are taken as ordinary text."""
        out, at = [], 0
        while at < len(text):
            end = at + 1
            while end < len(text) and (unicodedata.category(text[end])[0] == "M" or "\u1160" <= text[end] <= "\u11ff"):
                end += 1
            states, before = [self._state()], ""
            for k in range(at + 1, end + 1):
                now = "".join(c.lower() for c in unicodedata.normalize("NFC", text[at:k]))
                same = len(os.path.commonprefix((before, now)))
                self._back(states[same])
                del states[same + 1 :]
                for c in now[same:]:
                    self.push(c)
                    states.append(self._state())
                out.append(self.count())
                before = now
            at = end
        return out

    def counts(self, piece: str) -> list[int]:
        special = self.pieces.special
        parts = special.split(piece) if special else [piece]
        out: list[int] = []
        for text, mark in zip(parts[::2], [*parts[1::2], ""]):
            base = out[-1] if out else 0
            self._open("")
            own = self._plain(text + mark)
            if mark:
                own[-1] = (own[len(text) - 1] if text else 0) + 1
            out += [base + n for n in own]
        return out


def prefix_token_counts(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Adds ``n_tokens`` (exact, of the whole text; null counts as empty) and ``prefix_store``.

    All other columns pass through untouched, repeated rows and null ids included; columns of these two names
    are replaced, as by ``withColumn``."""
    path = path or default_path()
    names = [f"c{i}" for i in range(len(df.columns))]
    at = df.columns.index(text)
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, df.schema)] + [T.StructField("n", T.LongType()), T.StructField("s", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.get(path)
        for b in batches:
            stores = pieces.prefix_deltas([t or "" for t in b.column(at).to_pylist()])
            n = pa.array([int(unpack(s).sum(dtype=np.int64)) for s in stores], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, n, pa.array(stores, pa.binary())], [*names, "n", "s"])

    out = arrow_batches(df).toDF(*names).mapInArrow(run, schema)
    kept = [F.col(n).alias(c) for n, c in zip(names, df.columns) if c not in ("n_tokens", "prefix_store")]
    return out.select(*kept, F.col("n").alias("n_tokens"), F.col("s").alias("prefix_store"))


def count_at(store: str, n_chars: int) -> Column:
    """Token count of the first ``n_chars`` code points (all, if the text is shorter)."""

    @F.pandas_udf("long")
    def f(s):  # noqa: ANN001, ANN202 - a pandas UDF
        return s.map(lambda x: None if x is None else int(unpack(x)[:n_chars].sum(dtype=np.int64)))

    return f(F.col(store))


def fits_budget(store: str, budget: int = BUDGET) -> Column:
    """Code points of the longest prefix within a token budget."""

    @F.pandas_udf("long")
    def f(s):  # noqa: ANN001, ANN202 - a pandas UDF
        return s.map(lambda x: None if x is None else longest_within(x, budget))

    return f(F.col(store))


def token_counts(df: DataFrame, budget: int = BUDGET, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit and ``fit_chars``, the code points of the longest
    prefix within the budget, all read off the prefix store in the worker that made it."""
    path = path or default_path()
    slim = df.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()), T.StructField("fit_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        pieces = Pieces.get(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            stores = pieces.prefix_deltas(texts)
            n = [int(unpack(s).sum(dtype=np.int64)) for s in stores]
            fit = [len(t) if x <= budget else longest_within(s, budget) for t, s, x in zip(texts, stores, n)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pc.binary_length(b.column("text")).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > budget for x in n]), pa.array(fit, pa.int64())],
                schema.names,
            )

    return arrow_batches(slim).mapInArrow(run, schema)
