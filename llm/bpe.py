"""Exact BPE ids by dynamic programming over prefixes, and back to text.

Merging pairs in order of rank gives every prefix of a word one encoding, and the
encoding of a longer prefix ends with a token whose forerunner is the last token of
the prefix before it. So one number per prefix is enough: its last token. An
automaton over all tokens names those that end at a place; the one whose
neighbour to the left fits is stored. From the end, the stored tokens lead back.

Two tokens fit if merging their joint text would keep the border between them. While
merges run, the border lies between a right descendant of the one and a left
descendant of the other; it falls if those two form a pair whose rank comes before
the merges that take them up (of equal ranks the pair further left comes first).

The tokenizer file is a parameter: a BPE model whose tokens each come from one merge, of
tokens made earlier, with ends of words marked, and white space dropped. Normalising
and splitting into words are the file's own, by the tokenizers library. Words between white space are
remembered per Python worker, short ones only and up to a stated number.

Defined cases: a null text counts as empty and has no ids; the strings of special
tokens are those tokens; repeated rows get one result each; other columns are
kept, a column called like a result is replaced; no rows give no rows. Ids that the
file does not have are left out when decoding. Nothing is shuffled; a task holds one Arrow batch.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tokens import SPELLED

#: Words, pieces, and pairs of tokens, that one Python worker remembers, each; longer words and pieces than LONGEST bytes are not remembered.
REMEMBERED, LONGEST = 300_000, 48
#: Words that normalising only puts in lower case, with marks after them that are a word of their own.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,:;!?]*)").fullmatch
#: Added to the last character of a word, so that tokens at the end of words match there alone.
LAST = 0x1000
#: Bits of a character; the mark of the empty prefix; a rank that never comes.
SYMBOL, BEGIN, NEVER = 13, -2, 1 << 60


class WordModel:
    """The merges of a tokenizer file, as needed to encode single words."""

    def __init__(self, model: dict):
        end, vocab = model.get("end_of_word_suffix"), model["vocab"]
        if model["type"] != "BPE" or not end or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a BPE model with a suffix at the end of words is needed")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        size = max(vocab.values()) + 1
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        self.pairs: dict[int, int] = {}
        spelled: dict[int, str] = {}
        made = {a + b for a, b in merges}
        for token, number in vocab.items():
            if token not in made and len(stem := token.removesuffix(end)) == 1:
                spelled[number] = stem if stem == token else chr(ord(stem) + LAST)
        self._fits: dict[int, bool] = {}
        whole = set(spelled)
        for rank, (a, b) in enumerate(merges):
            one, other, token = vocab[a], vocab[b], vocab[a + b]
            if token in spelled or one not in spelled or other not in spelled:
                raise ValueError("every token must come from one merge of tokens made before it")
            self.left[token], self.right[token], self.rank[token] = one, other, rank
            spelled[token] = spelled[one] + spelled[other]
            # A token that its own text would not give is never used.
            if one in whole and other in whole and self._border(one, other):
                whole.add(token)
            self.pairs[one * size + other] = rank
        self.size, self.length = size, {t: len(spelled[t]) for t in whole}
        self._build({t: spelled[t] for t in whole})

    def _build(self, tokens: dict[int, str]) -> None:
        """The automaton: a state for every beginning of a token, with the tokens that end there, longest first."""
        self.edges: dict[int, int] = {}
        own, depth, parent = [-1], [0], [(0, 0)]
        for token, text in tokens.items():
            state = 0
            for c in map(ord, text):
                key = state << SYMBOL | c
                if key not in self.edges:
                    self.edges[key] = len(own)
                    own.append(-1)
                    depth.append(depth[state] + 1)
                    parent.append((state, c))
                state = self.edges[key]
            own[state] = token
        self.shorter, self.ends = [0] * len(own), [()] * len(own)
        self.go = dict(self.edges)
        for state in sorted(range(1, len(own)), key=depth.__getitem__):
            before, c = parent[state]
            shorter = self.shorter[state] = self._step(self.shorter[before], c) if before else 0
            here = ((own[state], depth[state]),) if own[state] >= 0 else ()
            self.ends[state] = here + self.ends[shorter]

    def _step(self, state: int, c: int) -> int:
        """The longest beginning of a token after one more character; remembered for both where it starts and ends."""
        start = state
        while (found := self.edges.get(state << SYMBOL | c)) is None and state:
            state = self.shorter[state]
        if len(self.go) >= len(self.edges) + REMEMBERED:
            self.go = dict(self.edges)
        found = self.go[start << SYMBOL | c] = found or 0
        return found

    def _border(self, a: int, b: int) -> bool:
        """Whether the border between two tokens outlasts all merges known so far."""
        pairs, size, up = self.pairs, len(self.left), NEVER
        while True:
            v, over = b, NEVER
            while True:
                rank = pairs.get(a * size + v)
                if rank is not None and rank < up and rank <= over:
                    return False
                if self.rank[v] < 0:
                    break
                v, over = self.left[v], self.rank[v]
            if self.rank[a] < 0:
                return True
            a, up = self.right[a], self.rank[a]

    def fits(self, a: int, b: int) -> bool:
        if len(self._fits) >= REMEMBERED:
            self._fits.clear()
        known = self._fits[a * self.size + b] = self._border(a, b)
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word, whose characters all are in the vocabulary."""
        codes = array("H", word.encode("utf-16-le"))
        codes[-1] += LAST
        size, known, go, ends = self.size, self._fits.get, self.go.get, self.ends
        last, state, place = [BEGIN], 0, 0
        for c in codes:
            place += 1
            after = go(state << SYMBOL | c)
            if after is None:
                after = self._step(state, c)
                go = self.go.get
            state = after
            for token, length in ends[state]:
                before = last[place - length]
                if before >= 0:
                    fit = known(before * size + token)
                    if fit or fit is None and self.fits(before, token):
                        last.append(token)
                        break
                elif before == BEGIN:
                    last.append(token)
                    break
            else:
                raise ValueError("the word has a character that the vocabulary lacks")
        ids, length = [], self.length
        while place:
            token = last[place]
            ids.append(token)
            place -= length[token]
        ids.reverse()
        return ids


class Codec(dict):
    """Ids of one piece between white space, as little-endian 32-bit numbers; of texts through ``ids``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.model = WordModel(stated["model"])
        library = Tokenizer.from_file(path)
        self.normalise: Callable = library.normalizer.normalize_str if library.normalizer else str
        self.words: Callable = library.pre_tokenizer.pre_tokenize_str
        added = stated.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError("added tokens must match as they are written, without white space")
        if self.words("a b") != [("a", (0, 1)), ("b", (2, 3))] or stated.get("decoder"):
            raise ValueError("the tokenizer must drop white space, and join tokens by one space")
        self.special = {t["content"]: t["id"] for t in added}
        self.known: dict[str, bytes] = {}
        # Whether this file splits and normalises a plain word with marks as PLAIN says.
        self.plain = [w for w, _ in self.words(self.normalise("AbÉ.,:;!?"))] == ["abé".encode().decode("latin-1").translate(SPELLED), ".,:;!?"]
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if added else None
        self.names = {number: token for token, number in stated["model"]["vocab"].items()} | {t["id"]: t["content"] for t in added}

    def _word(self, word: str) -> bytes:
        """Ids of a normalised word."""
        ids = self.known.get(word)
        if ids is None:
            ids = array("i", self.model.encode(word)).tobytes()
            if len(word) <= LONGEST:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def _encode(self, text: str) -> bytes:
        if self.plain and (found := PLAIN(text)):
            word, marks = found.groups()
            word = word.lower()
            ids = self._word(word if word.isascii() else word.encode().decode("latin-1").translate(SPELLED))
            return ids + self._word(marks) if marks else ids
        ids = []
        for part in self.parts.split(text) if self.parts else [text]:
            if part in self.special:
                ids.append(array("i", [self.special[part]]).tobytes())
            elif part:
                ids += [self._word(word) for word, _ in self.words(self.normalise(part))]
        return b"".join(ids)

    def __missing__(self, piece: bytes) -> bytes:
        ids = self._encode(piece.decode("utf-8", "replace"))
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        """No token spans white space, nor does normalising join what it parts."""
        return b"".join(map(self.__getitem__, text.split()))

    def text(self, ids: list[int]) -> str:
        try:
            return " ".join(map(self.names.__getitem__, ids))
        except KeyError:
            return " ".join([self.names[i] for i in ids if i in self.names])


_READY: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per worker and file."""
    if path not in _READY:
        _READY[path] = Codec(path)
    return _READY[path]


def _ids_of(texts: pa.Array, encode: Callable[[bytes], bytes]) -> pa.ListArray:
    every = [encode(t.as_buffer().to_pybytes()) for t in texts]
    offsets = np.cumsum([0, *map(len, every)]) // 4
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(every), np.int32)))


def _text_of(lists: pa.ListArray, decode: Callable[[list[int]], str]) -> pa.Array:
    return pa.array([decode(i.values.to_numpy(zero_copy_only=False).tolist()) if i.is_valid else "" for i in lists], pa.string())


def bpe_ids(text: Column, path: str) -> Column:
    """The ids of each text, as an array of int."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _ids_of(texts, codec(path).ids)

    return ids(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def bpe_text(ids: Column, path: str) -> Column:
    """The text of each array of ids; no ids, an empty text."""

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        return _text_of(lists, codec(path).text)

    return decoded(ids)


def bpe_round_trip(text: Column, path: str) -> Column:
    """Both, the ids of each text and the text of those ids, in one pass over the rows."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        ids = _ids_of(texts, codec(path).ids)
        return pa.StructArray.from_arrays([ids, _text_of(ids, codec(path).text)], ["ids", "decoded"])

    return both(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ids (array of int) of the whole text."""
    return docs.withColumn("ids", bpe_ids(F.col("text"), path))


def decode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with decoded, the text of ids."""
    return docs.withColumn("decoded", bpe_text(F.col("ids"), path))


def round_trip_documents(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ids and decoded."""
    kept = [c for c in docs.columns if c not in {"ids", "decoded"}]
    return docs.select(F.struct(*kept).alias("row"), bpe_round_trip(F.col("text"), path).alias("made")).select("row.*", "made.ids", "made.decoded")
