"""Token ids of whole texts, exactly as the library for a tokenizer file gives them.

Texts go to the ``tiktoken`` machine for the same merges, several times faster than the library and linear in a word's
length. It is used only where the file is a plain byte-level vocabulary whose merges stand in the order of their ids
(so that lowest id first is lowest rank first) with the published splitting rule. Texts that hold a special string, texts with
thousands of white-space characters in a row (too deep for the machine's splitter), and all texts under other files are read by the
library. Nothing is kept between texts.
"""

from __future__ import annotations

import json
from array import array

import tiktoken
from tokenizers import Tokenizer

from tradewind.llm.tokenizer_machine import byte_names

#: fixed value: the published splitting rule of this kind of tokenizer
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK = 2048  # a run of twice as many white-space characters fills a block


def ranks_of(spec: dict) -> dict[bytes, int] | None:
    """Bytes and ids of a plain byte-level vocabulary whose merges stand in the order of their ids; else None."""
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and not spec["normalizer"]
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    vocab, names = model["vocab"], byte_names()
    special = {t["content"] for t in spec["added_tokens"]}
    ids = [vocab["".join(m) if not isinstance(m, str) else m.replace(" ", "")] for m in model["merges"]]
    words = [t for t in vocab if t not in special]
    if ids != sorted(set(ids)) or len(words) != 256 + len(ids) or not all(c in names for t in words for c in t):
        return None
    return {bytes(names[c] for c in t): vocab[t] for t in words}


class TextEncoder:
    """Ids of texts as unsigned 32-bit little-endian bytes."""

    def __init__(self, source: str):
        spec = json.loads(source)
        ranks = ranks_of(spec)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.machine = ranks and tiktoken.Encoding("texts", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids of one whole text."""
        if self.machine and not any(s in text for s in self.special) and not any(
                text[k:k + BLOCK].isspace() for k in range(0, len(text), BLOCK)):
            return array("I", self.machine.encode_ordinary(text)).tobytes()
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()


_encoders: dict[str, TextEncoder] = {}


class EncoderSource:
    """What travels to the tasks: each Python worker builds the encoder once."""

    def __init__(self, broadcast):
        self.broadcast = broadcast

    def get(self) -> TextEncoder:
        from tradewind.llm import token_ids as here  # the module of this worker, not a copy of its state

        source = self.broadcast.value
        if source not in here._encoders:
            here._encoders.clear()
            here._encoders[source] = TextEncoder(source)
        return here._encoders[source]


def encoder_source(spark, path: str) -> EncoderSource:
    """A handle for tasks; a tokenizer file's size doesn't follow the data."""
    with open(path, encoding="utf-8") as file:
        return EncoderSource(spark.sparkContext.broadcast(file.read()))
