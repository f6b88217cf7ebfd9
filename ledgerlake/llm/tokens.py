"""Byte-level BPE ids of whole texts with a public vocabulary."""

from __future__ import annotations

import base64
import json
from array import array

import numpy as np

from ledgerlake.llm.hashing import worker_cache

VOCABULARY = "byte_bpe_50k"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed package of public tokenizers keeps the ranks.

    ``byte_bpe_50k.tiktoken`` holds the vocabulary of ``byte_bpe_50k.json`` with the same ids; the ranks are
    run because they take about an eighth of the time (tests compare the ids of the two).
    """
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


def added_tokens(name: str = VOCABULARY) -> dict[str, int]:
    """Strings that the vocabulary's file takes as one id each, wherever they stand."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


class Bpe:
    """Ids of texts as native uint32 bytes. ``added``: strings that are one id each; without, they are ordinary text."""

    def __init__(self, path: str | None = None, added: dict[str, int] | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(path or vocabulary_path(), "rb") as lines:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
        self.added = added or {}
        self.model = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        self.leads = np.zeros(len(ranks), np.int64)  # 1 for ids that start with a space
        for piece, i in ranks.items():
            self.leads[i] = piece[:1] == b" "

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i, t in enumerate(texts):
            same = i > 0 and t == texts[i - 1]  # copies often follow each other
            out.append(out[-1] if same else array("I", self._ids(t)).tobytes())
        return out

    def _ids(self, text: str) -> list[int]:
        if any(t in text for t in self.added):
            return self.model.encode(text, allowed_special="all")
        return self.model.encode_ordinary(text)


def worker_bpe(path: str | None = None, whole: bool = False) -> Bpe:
    """The tokenizer of this Python worker, kept from task to task; ``whole``: with the added tokens of its file."""
    kept = worker_cache()
    if ("bpe", path, whole) not in kept:
        kept["bpe", path, whole] = Bpe(path, added_tokens() if whole else None)
    return kept["bpe", path, whole]
