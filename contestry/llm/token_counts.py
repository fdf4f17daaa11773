"""Token counts by the whole-token shortcut.

A byte-level BPE cuts a text into pre-tokens and merges inside each of them. Before the job the driver
proves with the tokenizer's own library which strings of the vocabulary encode, alone, as one token: each
decodable entry is encoded. Tasks cut texts by the published pattern. A pre-token proved whole counts
one; of all others, each distinct one of a batch is merged by the library's model and counts what is left
of it.

Two libraries needn't agree on what a letter is: a task puts each character beyond ASCII, when it first
meets it, beside a letter, a digit and a sign, and reads its class from the library's cuts. A text with a
character of another class than the pattern gives it, or with the text of an added token (which the
library cuts out first), is encoded whole by the library. So are all texts under tokenizers of another
build, which the proof doesn't cover. Nothing is shuffled; what is sent to the tasks is bounded by the
vocabulary.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Fixed value: the published pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FILE = "byte_bpe_50k.json"
LIMIT = 512
#: Strings up to this many characters are remembered by a task, and so many of them.
REMEMBERED, MEMORY = 64, 200_000
#: Largest vocabulary whose proved strings are sent to tasks.
VOCABULARY = 1_000_000


class Shortcut(NamedTuple):
    """alone: strings that encode as one token; added: texts of added tokens. Both None where every text goes to the library."""

    alone: frozenset | None = None
    added: tuple[str, ...] | None = None


@lru_cache(maxsize=4)
def library(path: str):
    """text list -> list of token counts, without added tokens."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = loaded(path)
    return lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def loaded(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in the vocabulary: printable bytes themselves, the others numbered from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(0x100) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(0x100 + i) for i, b in enumerate(hidden)}}


def odd_characters(tokenizer, points: list[str]) -> set[str]:
    """Those of the characters that the library cuts otherwise than PATTERN does."""
    text = "".join(f"{c}a{c}1{c}!\n" for c in points)
    starts = {span[0] for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(text)}
    # a character isn't cut from what is of its class: a letter, a digit, a sign; white space is cut from all three
    cuts = ["".join(kind for kind, at in (("L", 1), ("N", 3), ("O", 5)) if 7 * i + at not in starts) or "S" for i in range(len(points))]
    mine = dict.fromkeys(points, "O")
    for kind, of in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s")):
        mine.update(dict.fromkeys(regex.findall(of, "".join(points)), kind))
    return {c for c, kind in zip(points, cuts) if kind != mine[c]}


@lru_cache(maxsize=4)
def prove(path: str) -> Shortcut:
    """What the tasks may count without merging, for the tokenizer in the file."""
    if not path.endswith(".json"):
        return Shortcut()
    with open(path, encoding="utf-8") as f:
        built = json.load(f)
    cutter = built.get("pre_tokenizer") or {}
    covered = built["model"].get("type") == "BPE" and not built.get("normalizer") and cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
    if not covered or len(built["model"]["vocab"]) > VOCABULARY:
        return Shortcut()
    tokenizer, cut = loaded(path), regex.compile(PATTERN)
    added = tuple(t["content"] for t in built.get("added_tokens", []))
    texts = tokenizer.decode_batch([[i] for i in range(tokenizer.get_vocab_size())], skip_special_tokens=False)
    pieces = [t for t in texts if t and "\N{REPLACEMENT CHARACTER}" not in t and cut.findall(t) == [t] and not any(a in t for a in added)]
    odd = odd_characters(tokenizer, sorted(c for c in set("".join(pieces)) if c > "\x7f"))
    pieces = [t for t in pieces if odd.isdisjoint(t)]
    return Shortcut(frozenset(t for t, n in zip(pieces, library(path)(pieces)) if n == 1), added)


def counter(path: str, shortcut: Shortcut):
    """A function from a list of texts to their token counts."""
    encode = library(path)
    if shortcut.alone is None:
        return encode
    cut, tokenizer = regex.compile(PATTERN), loaded(path)
    merges, letters = tokenizer.model, byte_letters()
    known, met, odd = dict.fromkeys(shortcut.alone, 1), set(), set()

    def covered(text: str) -> bool:
        if any(a in text for a in shortcut.added):
            return False
        if text.isascii():
            return True
        characters = set(text)
        if new := sorted(c for c in characters - met if c > "\x7f"):
            odd.update(odd_characters(tokenizer, new))
            met.update(new)
        return odd.isdisjoint(characters)

    def count(texts: list[str]) -> list[int]:
        cuts = {i: cut.findall(text) for i, text in enumerate(texts) if covered(text)}
        new = list(set().union(*cuts.values()).difference(known))
        known.update((p, len(merges.tokenize(p.encode().decode("latin-1").translate(letters)))) for p in new)
        out = [sum(map(known.__getitem__, cuts.get(i, ()))) for i in range(len(texts))]
        left = [i for i in range(len(texts)) if i not in cuts]
        for i, n in zip(left, encode([texts[i] for i in left])):
            out[i] = n
        if len(known) > len(shortcut.alone) + MEMORY:
            known.clear()
            known.update(dict.fromkeys(shortcut.alone, 1))
        for long in (p for p in new if len(p) > REMEMBERED):
            known.pop(long, None)
        return out

    return count


def portions(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """The texts in order, in lists of about so many characters, so that few pre-tokens are held at once."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than limit tokens) of every document, by the tokenizer in the file.

    The file lies at the same path on all machines. Null texts are empty and have no tokens; special
    strings inside a text count as the library's default has it; empty, repeated and very long texts
    are counted like any other, and an empty table gives no rows. Other columns aren't read.
    """
    proved = docs.sparkSession.sparkContext.broadcast(prove(path))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in found:
            count = count or counter(path, proved.value)
            n = pa.array([x for some in portions(batch.column("text").to_pylist()) for x in count(some)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    read = docs.select("doc_id", F.octet_length(text_of(F.col("text"))).cast("long").alias("n_bytes"), text_of(F.col("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = read.mapInArrow(batches, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
