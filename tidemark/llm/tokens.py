"""Token ids of texts by a public tokenizer, with a cache of pre-tokens.

A byte-level tokenizer first cuts a text by a pattern and merges within the matches only (``pretokens``). So the ids of a text
are those of its matches, one after another, and the library's merge model is asked once per distinct match as long as
that is cached. Matches are told apart by their bytes. Texts that hold the text of a special token, and all texts of
tokenizers of another kind, are given to the library whole.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tidemark.llm.pretokens import gathered, listed, matches, numbered

#: How byte-level vocabularies spell bytes that are no visible characters.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLING = {b: chr(b) for b in VISIBLE} | {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*VISIBLE}))}
#: Distinct matches whose ids a worker keeps, some 200 bytes each.
KEEP = 100_000
_loaded: dict[str, "Encoder"] = {}


class Known:
    """Ids of strings of bytes. ``ask`` gives those of new ones, each distinct one once while it is kept; with more than ``keep`` the
    cache begins anew."""

    def __init__(self, ask: Callable[[list[bytes]], Iterable[list[int]]], keep: int = KEEP) -> None:
        self.ask, self.keep = ask, keep
        self._begin()

    def _begin(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.bounds = array("I"), array("q", [0])

    def _learn(self, words: list[bytes]) -> None:
        for word, ids in zip(words, self.ask(words)):
            self.known[word] = len(self.known)
            self.flat.extend(ids)
            self.bounds.append(len(self.flat))

    def of(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all values, one after another; where those of each end)."""
        index, distinct = numbered(values)
        words = listed(distinct)
        new = [w for w in words if w not in self.known]
        if new and len(self.known) + len(new) > self.keep:
            self._begin()
            new = words
        self._learn(new)
        row = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        bounds, flat = np.frombuffer(self.bounds, np.int64), np.frombuffer(self.flat, np.uint32)
        return gathered(row[index], bounds, flat)  # copies; the arrays can't grow while they are viewed


class Encoder:
    """Ids of texts. With ``plain`` the texts of special tokens are ordinary text."""

    def __init__(self, path: str, keep: int = KEEP, plain: bool = False) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        # only for this kind are the cuts known; others are encoded whole
        cut = kind.get("pre_tokenizer") or {}
        self.cuts = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and kind.get("normalizer") is None and kind["model"].get("type") == "BPE" and not kind["model"].get("ignore_merges")
        )
        self.known = Known(self.merge, keep)

    def merge(self, words: list[bytes]) -> Iterable[list[int]]:
        """The ids of words that are no further cut."""
        merge = self.library.model.tokenize
        return ([t.id for t in merge(w.decode("latin-1").translate(SPELLING))] for w in words)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text]))[0]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where those of each text end."""
        texts = pc.fill_null(texts, "")
        whole = np.full(len(texts), not self.cuts)
        for special in self.special if self.cuts else ():
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(whole).tolist()
        found, ends = matches(pc.if_else(pa.array(whole), "", texts) if rest else texts)
        ids, stop = self.known.of(found)
        ends = np.append(0, stop)[ends]
        if not rest:
            return ids, ends
        lengths, parts, at = np.diff(ends, prepend=0), [], 0
        for i in rest:  # the other texts, put in at their places
            own = np.array(self.library.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            parts += [ids[at : ends[i]], own]
            at, lengths[i] = ends[i], len(own)
        return np.concatenate([*parts, ids[at:]]), np.cumsum(lengths)


def encoder(path: str) -> Encoder:
    """One encoder per tokenizer file and Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def strings(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts with one more id at the end of each."""
    after = ends + np.arange(1, len(ends) + 1)
    out = np.empty(len(ids) + len(ends), np.uint32)
    inner = np.ones(len(out), bool)
    inner[after - 1] = False
    out[np.flatnonzero(inner)] = ids
    out[after - 1] = end_id
    return out, after


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
