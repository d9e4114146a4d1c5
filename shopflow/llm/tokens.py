"""Token ids of whole texts, as the tokenizers library gives them, for use inside Spark tasks.

``ByteBpe`` encodes with a byte-level BPE file.  Ordinary texts go through the tiktoken encoder
of the same vocabulary, which is several times faster and gives the same ids; texts that hold a
special token's string, characters beyond the long-settled Unicode ranges (whose letter classes
may differ between the two libraries' tables) or huge runs of white space go through the
tokenizers library itself, and so do all texts if the file is not a plain byte-level BPE (a normalizer,
a prefix space, another split, dropout, affixes, byte fallback).
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

# fixed value: the pre-token pattern of the byte-level vocabularies, in its backtracking-free form
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_UNSETTLED = re.compile("[^\x00-\u024f\u2010-\u2027]")
_WHITE_RUN = re.compile(r"\s{4096}")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 bytes stand for themselves,
    the others for code points from 256 on, in byte order."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class ByteBpe:
    """Whole-text encoder of one byte-level BPE vocabulary file (tokenizers JSON)."""

    def __init__(self, path: str):
        import tiktoken

        self.tokenizer = load_tokenizer(path)
        self.fast = None
        vocabulary = self.tokenizer.get_vocab()
        self.n_ids = 1 + max(vocabulary.values())
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not plain_byte_level(spec):
            return
        specials = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        alphabet = byte_alphabet()
        raw = {t: t.encode() if t in specials else bytes(alphabet[c] for c in t) for t in vocabulary}
        self.n_bytes = np.zeros(self.n_ids, dtype=np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(raw[token])
        id_of = {raw[t]: i for t, i in vocabulary.items() if t not in specials}
        ranks = _merge_ranks(spec["model"]["merges"], id_of)
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.id_of_rank = np.zeros(len(ranks), dtype=np.uint32)
        for token, rank in ranks.items():
            self.id_of_rank[rank] = id_of[token]

    @property
    def dtype(self) -> str:
        """Little-endian integer type that holds every id of the vocabulary."""
        return "<u2" if self.n_ids <= 1 << 16 else "<u4"

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text (uint32), without special tokens added."""
        if self.fast is not None and self._plain(text):
            return self.id_of_rank[self.fast.encode_ordinary(text)]
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _plain(self, text: str) -> bool:
        if self.special and self.special.search(text):
            return False
        if len(text) > 4096 and _WHITE_RUN.search(text):
            return False
        try:
            text.encode("latin-1")  # much faster than a search for the usual text
        except UnicodeEncodeError:
            return not _UNSETTLED.search(text)
        return True


def plain_byte_level(spec: dict) -> bool:
    """Whether a tokenizers file says byte-level BPE with nothing that changes the text or its pieces."""
    split, model, added = spec.get("pre_tokenizer") or {}, spec.get("model") or {}, spec.get("added_tokens") or []
    return (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
            and split.get("use_regex", True) and model.get("type") == "BPE" and not any(model.get(k) for k in (
                "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")))


def _merge_ranks(merges: list, id_of: dict[bytes, int]) -> dict[bytes, int]:
    """Byte string -> merge priority: single bytes first, then the file's merges in their order."""
    alphabet = byte_alphabet()
    ranks = {raw: i for i, raw in enumerate(sorted((bytes([b]) for b in range(256)), key=id_of.__getitem__))}
    for merge in merges:
        pair = merge if isinstance(merge, list) else merge.split(" ")
        ranks.setdefault(bytes(alphabet[c] for c in "".join(pair)), len(ranks))
    return ranks


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per Python worker and file."""
    return ByteBpe(path)
