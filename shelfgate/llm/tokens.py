"""Word-wise encoding with a public tokenizer file, inside a task.

The tokenizers handled here drop white space before the model runs, so a
text's ids are the ids of its white-space separated words one after the
other, and every distinct word needs encoding only once.
"""

from __future__ import annotations

import json
import os
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# An ASCII punctuation run between a Latin letter and white space is a word of its own for the
# pre-tokenizer below; cutting there leaves fewer distinct words.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_CUT = rf"([{_LETTERS}])([.,;:!?#$%&*]+)(\s|$)"
_PRETOKENS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
CACHE_WORDS = 400_000


def _byte_chars() -> dict[int, str]:
    """Bytes as the printable characters that byte-level vocabularies use: printable Latin-1
    stands for itself, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes lists of words; the tokenizer file must drop white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = pre[0].get("pattern", {}).get("Regex") if pre else None
        # For this layout a word of Latin letters alone is one lower-cased piece of the model's input.
        self.latin = (kinds == ["NFC", "Replace", "Lowercase"] and split == _PRETOKENS
                      and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout"))
        if self.ids(["a b"]) != [b"".join(self.ids(["a", "b"]))]:
            raise ValueError(f"{path}: ids of words depend on the white space between them")
        self._table = str.maketrans({chr(b): c for b, c in _byte_chars().items()})
        self._cache: OrderedDict[str, bytes] = OrderedDict()

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, by the full tokenizer."""
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def encode(self, words: pa.Array) -> list[bytes]:
        """Ids of each word; the caller passes distinct words."""
        out: list[bytes] = [b""] * len(words)
        texts = words.to_pylist()
        easy = (pc.match_substring_regex(words, f"^[{_LETTERS}]+$").to_numpy(zero_copy_only=False)
                if self.latin else np.zeros(len(texts), bool))
        model, table = self.tokenizer.model, self._table
        rest = []
        for i, (w, is_easy) in enumerate(zip(texts, easy)):
            if is_easy:
                piece = w.lower()
                if not piece.isascii():
                    piece = piece.encode().decode("latin-1").translate(table)
                out[i] = np.asarray([t.id for t in model.tokenize(piece)], "<u4").tobytes()
            elif w:
                rest.append(i)
        for i, b in zip(rest, self.ids([texts[i] for i in rest])):
            out[i] = b
        return out

    def encode_cached(self, words: pa.Array) -> list[bytes]:
        """As :meth:`encode`, remembering the last ``CACHE_WORDS`` words of this process."""
        cache, texts = self._cache, words.to_pylist()
        missing = [i for i, w in enumerate(texts) if w not in cache]
        for i, b in zip(missing, self.encode(words.take(pa.array(missing, pa.int64())))):
            cache[texts[i]] = b
        out = [cache[w] for w in texts]
        while len(cache) > CACHE_WORDS:
            cache.popitem(last=False)
        return out

    def split(self, text: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Words of each text as (offsets, words). Only ASCII white space separates, whatever
        else the tokenizer drops stays in the word."""
        if self.latin:
            text = pc.replace_substring_regex(text, _CUT, r"\1 \2\3")
        lists = pc.ascii_split_whitespace(text)
        return lists.offsets.to_numpy().astype(np.int64), lists.flatten()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def gather(codes: np.ndarray, table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a sequence of words given as indices into ``table``: (ids, id offsets by word)."""
    flat = np.frombuffer(b"".join(table), "<u4")
    lengths = np.fromiter((len(b) // 4 for b in table), np.int64, len(table))
    first = np.cumsum(lengths) - lengths
    n = lengths[codes] if len(codes) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(first[codes] - ends[:-1], n) + np.arange(ends[-1]) if len(codes) else np.zeros(0, np.int64)
    return flat[at], ends


def string_column(batch, name: str) -> pa.Array:
    """A text column as one array, null as empty."""
    col = batch.column(name)
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    return pc.fill_null(col.cast(pa.string()), "")
