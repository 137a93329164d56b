"""Byte-pair encoding and decoding by dynamic programming over prefixes.

For every prefix of a word there is one token that ends the prefix's encoding. It is found among the
tokens that are suffixes of the prefix (read off an automaton over the vocabulary, longest first): the
one that is compatible with the stored last token of the prefix before it. Following the stored tokens
backwards from the whole word gives exactly the ids that merging by rank gives, in time linear in the word.

Nulls count as empty text; empty text has no ids. Texts of any length are encoded whole. Each row is encoded by itself,
so repeated rows and ids give repeated results, and rows without an id are encoded like any other; there are no ties, since
each prefix has one last token. Columns besides the key and the text play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

NEVER = 1 << 60
#: Unicode White_Space; str.split() also splits at U+001C..U+001F, which are not in it.
WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPLIT_WHITE = re.compile(f"[{WHITE}]+")
#: What a byte-level vocabulary writes for each byte: printable Latin-1 as it is, the others from U+0100 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}
#: Keeps the last character of a word, when the vocabulary marks word ends, apart from the same character within.
END = 0x4000
#: Entries that a worker keeps of words and of token pairs before it starts anew.
CACHE = 400_000


class Bpe:
    """The merges of one vocabulary, ready to encode words given as strings of vocabulary characters."""

    def __init__(self, vocab: dict[str, int], merges: list, end_of_word: str = ""):
        self.end_of_word = end_of_word
        self.names = {i: t for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(merges):
            a, b = pair if not isinstance(pair, str) else pair.split(" ", 1)
            whole = vocab[a + b]
            self.rank.setdefault((vocab[a], vocab[b]), r)
            parts.setdefault(whole, (vocab[a], vocab[b], r))
        self.parts = parts
        self._left: dict[int, list] = {}
        self._right: dict[int, list] = {}
        self._fits: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        self._build({i: self._symbols(t) for t, i in vocab.items()})

    def _symbols(self, token: str) -> str:
        if self.end_of_word and token.endswith(self.end_of_word) and token != self.end_of_word:
            return self.mark(token[: -len(self.end_of_word)])
        return token

    def mark(self, word: str) -> str:
        """The word's characters as symbols, the last one apart where the vocabulary marks word ends."""
        return word[:-1] + chr(ord(word[-1]) + END) if self.end_of_word else word

    def _build(self, symbols: dict[int, str]) -> None:
        """Automaton over all tokens: a state is the longest token prefix that ends here."""
        self.step: list[dict[str, int]] = [{}]
        token_at: dict[int, int] = {}
        self.length = {i: len(s) for i, s in symbols.items()}
        for i, s in symbols.items():
            state = 0
            for c in s:
                nxt = self.step[state].get(c)
                if nxt is None:
                    nxt = self.step[state][c] = len(self.step)
                    self.step.append({})
                state = nxt
            token_at[state] = i
        self.fall = [0] * len(self.step)
        self.ends: list[tuple] = [()] * len(self.step)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            own = token_at.get(state)
            self.ends[state] = (((own, self.length[own]),) if own is not None else ()) + (self.ends[self.fall[state]] if state else ())
            for c, nxt in self.step[state].items():
                back = self.fall[state]
                while state and back and c not in self.step[back]:
                    back = self.fall[back]
                self.fall[nxt] = self.step[back].get(c, 0) if state else 0
                queue.append(nxt)

    def _move(self, state: int, c: str) -> int:
        """Where c leads from a state that no longer token continues; noted there (at most states x symbols notes)."""
        back = state
        while back and c not in self.step[back]:
            back = self.fall[back]
        to = self.step[state][c] = self.step[back].get(c, 0)
        return to

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token in the order in which merging forms them, each with the rank that ends it."""
        kept = self._right if side else self._left
        found = kept.get(token)
        if found is None:
            piece, until, found = token, NEVER, []
            while True:
                found.append((piece, until))
                if piece not in self.parts:
                    break
                until = self.parts[piece][2]
                piece = self.parts[piece][side]
            found.reverse()
            kept[token] = found
        return found

    def _apart(self, a: int, b: int, joined: bool) -> bool:
        """Whether merging a's and b's text never merges across their border; joined: but for the last merge of both."""
        left, right, i, j = self._edge(a, 1), self._edge(b, 0), 0, 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            r = self.rank.get((x, y), NEVER)
            last = x_until == NEVER and y_until == NEVER
            # of two merges of one rank the one further left comes first
            if r < x_until and r <= y_until and not (joined and last):
                return False
            if last:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def fits(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 4 * CACHE:
                self._fits.clear()
            known = self._fits[key] = self._apart(a, b, joined=False)
        return known

    def alone(self, token: int) -> bool:
        """Whether a token's own text is encoded as that token."""
        known = self._alone.get(token)
        if known is None:
            known = True
            if token in self.parts:
                a, b, _ = self.parts[token]
                known = self.alone(a) and self.alone(b) and self._apart(a, b, joined=True)
            self._alone[token] = known
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word, given as vocabulary characters."""
        if not word:
            return []
        step, ends, fits, move = self.step, self.ends, self._fits, self._move
        last, state = [-1], 0
        for end, c in enumerate(self.mark(word), 1):
            nxt = step[state].get(c)
            state = move(state, c) if nxt is None else nxt
            for token, size in ends[state]:
                if end == size:
                    if self.alone(token):
                        break
                else:
                    before = last[end - size]
                    if before >= 0:
                        ok = fits.get(before << 20 | token)
                        if ok or (ok is None and self.fits(before, token)):
                            break
            else:
                token = -1
            last.append(token)
        ids, end = [], len(word)
        while end > 0:
            token = last[end]
            if token < 0:  # a character that the vocabulary lacks is left out
                end -= 1
                continue
            ids.append(token)
            end -= self.length[token]
        ids.reverse()
        return ids


class WordCodec:
    """A vocabulary file of words: NFC, lower case, white space dropped, byte-level symbols, marked word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.bpe = Bpe(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.names = self.bpe.names | {i: t for t, i in self.special.items()}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
        self._rules = Tokenizer.from_file(path)
        self.known: dict[str, tuple[bytes, bytes, int]] = {}
        self._word_ids: dict[str, list[int]] = {}

    def _plain(self, chunk: str) -> list[int]:
        out: list[int] = []
        for word in self._cut(chunk):
            ids = self._word_ids.get(word)
            if ids is None:
                ids = self.bpe.encode(word)
                if len(self._word_ids) > CACHE:
                    self._word_ids.clear()
                if len(word) < 100:
                    self._word_ids[word] = ids
            out += ids
        return out

    def _cut(self, chunk: str) -> list[str]:
        """Words in vocabulary characters. Beyond Latin, where Unicode versions differ, the file's own rules cut."""
        if not chunk.isascii() and max(chunk) > "\u024f":
            return [w for w, _ in self._rules.pre_tokenizer.pre_tokenize_str(self._rules.normalizer.normalize_str(chunk))]
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk)
        return ["".join(map(BYTE_CHARS.__getitem__, w.encode())) for w in self._words.findall(chunk.lower())]

    def chunks(self, text: str) -> list[str]:
        """Parts between white space. No token spans two of them."""
        if _ODD_SPACE.search(text):
            return [x for x in _SPLIT_WHITE.split(text) if x]
        return text.split()

    def chunk_ids(self, chunk: str) -> list[int]:
        if self._special is None or "<|" not in chunk:
            return self._plain(chunk)
        out: list[int] = []
        for part in self._special.split(chunk):
            out += [self.special[part]] if part in self.special else self._plain(part)
        return out

    def encode(self, text: str | None) -> list[int]:
        return [i for c in self.chunks(text or "") for i in self.chunk_ids(c)]

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by a space, as a vocabulary file without a decoder asks for."""
        return " ".join(self.names[i] for i in ids if i in self.names)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Token count, SHA-256 of the decimal ids, SHA-256 of the decoded text."""
        known, parts = self.known, []
        for chunk in self.chunks(text or ""):
            got = known.get(chunk)
            if got is None:
                ids = self.chunk_ids(chunk)
                got = (" ".join(map(str, ids)).encode(), self.decode(ids).encode(), len(ids))
                if len(known) > CACHE:
                    known.clear()
                if len(chunk) < 100:
                    known[chunk] = got
            if got[2]:
                parts.append(got)
        ids_hash = hashlib.sha256(b" ".join([p[0] for p in parts])).hexdigest()
        return sum([p[2] for p in parts]), ids_hash, hashlib.sha256(b" ".join([p[1] for p in parts])).hexdigest()


@lru_cache(maxsize=4)
def codec(path: str) -> WordCodec:
    """One per Python worker and file."""
    return WordCodec(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of each text."""

    @F.udf("array<int>", useArrow=True)
    def run(value):
        return codec(path).encode(value)

    return df.withColumn(ids, run(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of each list of ids; null ids give empty text."""

    @F.udf("string", useArrow=True)
    def run(value):
        return codec(path).decode([] if value is None else list(value))

    return df.withColumn(text, run(F.col(ids)))


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256 and decoded_sha256 of each whole text. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path)
        for b in batches:
            n, ids, back = zip(*map(use.digest, b.column(1).to_pylist())) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
