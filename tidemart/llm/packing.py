"""Packing token streams into fixed windows: concatenate and cut."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

TOKENS = "id {id}, part int, begins long, n long, ids binary"


#: Fixed value: how the tokenizer's file cuts lower-cased words into pieces.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

#: The other steps of the files whose words are cut here.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": PIECES.pattern}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

#: Words of visible characters up to the Latin blocks and their accents.
PLAIN = re.compile("[!-~\xa1-\u036f]+")


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: itself
    if it is a visible Latin-1 character, else the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(other)) for b in range(256)]


def cuts_words(layout: dict) -> bool:
    """Whether a tokenizer's file takes the steps of ``NORMALIZER``, ``PIECES``
    and a byte-level model, with no added token but ones like ``<|name|>``."""
    return (layout["normalizer"] == NORMALIZER and layout["pre_tokenizer"] == PRE_TOKENIZER and layout["model"]["type"] == "BPE"
            and all("<|" in t["content"] and not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"]
                    for t in layout["added_tokens"]))


class WordTokenizer:
    """Whole-text token ids as bytes, of any tokenizer file; texts are never
    truncated or padded.  A file that doesn't cut words as ``cuts_words`` says
    encodes each text in one call; the others, word by word:

    ``word_bpe_49k.json`` drops white space and splits at it, so the ids of a
    text are those of its words in turn, and a word's are those of its
    pieces.  Words and pieces are kept in tables of at most ``words`` entries
    each; once full, what isn't in them is encoded each time.  Words of Latin
    script (``PLAIN``) are cut here as the file says and given to the tokenizer's
    model; any other word, or one that may hold a special token, goes through
    the whole tokenizer.  Ids are little-endian unsigned 32-bit."""

    def __init__(self, path: str, words: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = cuts_words(json.loads(self.tokenizer.to_str()))
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.words = words

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            text = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            ids = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
            if len(self.pieces) < self.words:
                self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        if not PLAIN.fullmatch(word) or "<|" in word:
            return self.encode(word)
        word = (word if word.isascii() else unicodedata.normalize("NFC", word)).lower()
        if word.isalpha():  # letters alone are one piece
            return self.piece(word)
        if word[-1] in ",." and word[:-1].isalpha():
            return self.piece(word[:-1]) + self.piece(word[-1])
        return b"".join(map(self.piece, PIECES.findall(word)))

    def text(self, text: str) -> bytes:
        """Only a space and a line feed split words here; other white space
        stays inside a word and is the tokenizer's to handle."""
        if not self.by_word:
            return self.encode(text)
        words, known = text.replace("\n", " ").split(" "), self.known
        ids = list(map(known.get, words))
        if None in ids:
            for i, x in enumerate(ids):
                if x is None:
                    x = known.get(words[i]) or self.word(words[i])
                    ids[i] = x
                    if len(known) < self.words:
                        known[words[i]] = x
        return b"".join(ids)


#: One tokenizer for each file and Python worker, kept over its tasks.
_LOADED: dict[tuple[str, int], WordTokenizer] = {}


def tokenize(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int, words: int) -> DataFrame:
    """First pass: (id, part, begins, n, ids).  ``begins`` counts the tokens
    that the same partition holds before the row."""
    end = np.array([end_id], "<u4").tobytes()
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = TOKENS.format(id=src.schema["id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, words)
        tokenizer = _LOADED.get(key) or _LOADED.setdefault(key, WordTokenizer(*key))
        part, begins = TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # small batches out, whatever came in
                b = whole.slice(at, 256)
                ids = [tokenizer.text(x) + end for x in b.column("text").to_pylist()]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                upto = begins + np.cumsum(n)
                begins = int(upto[-1])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(np.full(len(n), part, np.int32)), pa.array(upto - n), pa.array(n),
                     pa.array(ids, pa.binary())], names=["id", "part", "begins", "n", "ids"])

    return src.mapInArrow(run, schema)


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = 4096, end_id: int = 2, cache_words: int = 1 << 20) -> DataFrame:
    """Concatenate all documents' tokens and cut them every ``window`` tokens.

    First pass: tokenize (each text's ids, then ``end_id``) with a running
    count inside each partition, stored.  The partition totals, one row per
    partition, are summed up in partition order; a document's global offset
    is its partition's base plus its count.  Second pass: the windows a
    document touches follow from its offset, and each gives one boundary
    record.  Every window is full but the last, so no padding is needed
    before it.  Nothing but the totals is ever ordered or gathered.

    Returns one row per piece: doc_id, start, length, ids (binary, unsigned
    little-endian 32-bit), doc_tokens, sequence_id, offset.  Null and empty
    texts are the one id ``end_id``; identical rows are packed each; an empty
    table gives no rows; further columns are ignored.  At most
    ``cache_words`` words are remembered per Python worker."""
    rows = stored(tokenize(df, id_col, text_col, tokenizer_path, end_id, cache_words), "pack-tokens")
    totals = rows.groupBy("part").agg(F.max(F.col("begins") + F.col("n")).alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = stored(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "pack-bases")
    at = rows.join(bases, "part").select("id", "n", "ids", (F.col("base") + F.col("begins")).alias("at"))
    first, last = F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("n") - 1) / window)
    pieces = (at.select("*", F.explode(F.sequence(first, last)).alias("sequence_id"))
              .withColumn("start", F.greatest(F.col("sequence_id") * window - F.col("at"), F.lit(0)))
              .withColumn("length", F.least((F.col("sequence_id") + 1) * window - F.col("at"), F.col("n")) - F.col("start")))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length",
        F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("ids"),
        F.col("n").alias("doc_tokens"), "sequence_id",
        F.greatest(F.col("at") - F.col("sequence_id") * window, F.lit(0)).alias("offset"))
