"""Token counts by whole tokens: pre-tokens that the vocabulary holds whole count one, only the rest are merged."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, worker_cache

#: Tokens from which on a text is over the limit.
LIMIT = 512
#: Pre-tokens whose counts a worker remembers, besides the vocabulary; longer ones than this are merged each time.
REMEMBERED, LONGEST = 1_000_000, 200
#: Characters of a text that are looked at together, about: it is cut where a space follows something else.
TOGETHER = 1 << 20
#: From this character on, a part of a text is left to the library.
PLANE = 0x10000
#: Fixed value: the vocabulary's own cut of a text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others for
    the letters from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def whole_tokens(path: str) -> list[str]:
    """The proof, made once and before any text is read: the strings of the vocabulary that are one pre-token and that the
    library's own merges lead to one token. A string of the vocabulary that no order of merges reaches isn't among them."""
    import regex

    tokenizer, letters, cut = library(path), byte_letters(), regex.compile(PATTERN)
    texts = []
    for t in tokenizer.get_vocab(with_added_tokens=False):
        try:
            texts.append(bytes(letters[c] for c in t).decode())
        except (KeyError, UnicodeDecodeError):  # a part of a character, or no string of bytes
            continue
    texts = sorted(t for t in texts if cut.fullmatch(t))
    alone = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, alone) if len(e.ids) == 1]


def disputed(path: str) -> str:
    """The characters below PLANE of which the library's cut and ours think differently, as they know different versions
    of Unicode: each stands between a letter and a digit, where letters, digits, spaces and the rest are cut differently."""
    chars = [chr(c) for c in range(1, PLANE) if not 0xD800 <= c <= 0xDFFF]
    ours, pre, out = compiled_pattern(), library(path).pre_tokenizer, set()
    for at in range(0, len(chars), 512):
        group = chars[at : at + 512]
        text = "".join([f"a{c}1\n" for c in group])
        cuts = {x for _, x in pre.pre_tokenize_str(text)} ^ {m.span() for m in ours.finditer(text)}
        out |= {group[place // 4] for a, b in cuts for place in (a, b - 1)}
    return "".join(sorted(out))


def ranges(of: str) -> str:
    """A character class for re of what a class of regex holds below PLANE: plain ranges are looked up in a bitmap."""
    import regex

    own = regex.compile(of)
    at = [c for c in range(PLANE) if own.match(chr(c))]
    starts = [c for c, before in zip(at, [-2, *at]) if c != before + 1]
    ends = [c for c, after in zip(at, [*at[1:], -2]) if c + 1 != after]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends))


def compiled_pattern() -> re.Pattern:
    """PATTERN for texts without characters from PLANE on."""
    letters, digits, spaces = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    own = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{digits}]")
    for name, chars in ((r"\p{L}", letters), (r"\p{N}", digits), (r"\s", spaces)):
        own = own.replace(name, f"[{chars}]")
    return re.compile(own.replace(r"\S", f"[^{spaces}]"))


class Counter(dict):
    """How many tokens each pre-token has. It begins with the whole tokens, at one each; a pre-token that isn't there is
    merged by the library and remembered."""

    def __init__(self, path: str, whole: list[str], unsure: str):
        super().__init__(dict.fromkeys(whole, 1))
        self.tokenizer, self.whole, self.room = library(path), len(whole), len(whole) + REMEMBERED
        self.merge, self.letters = self.tokenizer.model.tokenize, {b: c for c, b in byte_letters().items()}
        self.cut = compiled_pattern().findall
        self.end = re.compile(r"(?<=\S)(?=[ \n])")
        self.unsure = re.compile(f"[{re.escape(unsure)}{chr(PLANE)}-{chr(sys.maxunicode)}]").search
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        if self.tokenizer.normalizer or any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("this vocabulary changes texts, or takes in what stands around its special strings")
        names = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None

    def __missing__(self, pre: str) -> int:
        n = len(self.merge(pre.encode().decode("latin-1").translate(self.letters)))
        if len(pre) <= LONGEST:
            if len(self) > self.room:
                for k in list(self)[self.whole :]:  # what was remembered last comes last
                    del self[k]
            self[pre] = n
        return n

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts of some TOGETHER characters: where a space follows something else, a pre-token ends always."""
        at = 0
        while len(text) - at > 2 * TOGETHER and (m := self.end.search(text, at + TOGETHER)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def count(self, text: str) -> int:
        """Tokens of a whole text: special strings are one each, as the library has it; pre-tokens are looked up."""
        n, at, stretches = 0, 0, [text]
        if self.special and (found := [m.span() for m in self.special.finditer(text)]):
            stretches = []
            for a, b in found:
                stretches.append(text[at:a])
                at = b
            stretches.append(text[at:])
            n = len(found)
        for s in stretches:
            for part in self.parts(s):
                n += self.encoded(part) if self.unsure(part) else sum(map(self.__getitem__, self.cut(part)))
        return n


def counted(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of docs (doc_id, text): the bytes of the text in UTF-8, its
    tokens as the library for the tokenizer counts them without tokens of its own, and whether they are more than limit.

    A null text counts as empty: no bytes, no tokens. A null doc_id stays null; repeated rows give a row each; an empty
    table gives no rows; other columns are ignored, whatever their names. Texts of any length are read whole, a part at a
    time. A text with a character that only one of two versions of Unicode knows is encoded by the library alone.
    """
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    # Both are bounded: by the vocabulary, and by the characters that there are.
    proof = spark.sparkContext.broadcast((whole_tokens(path), disputed(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(f"token counts {path}", lambda: Counter(path, *proof.value))
        for b in batches:
            texts = b.column(1).to_pylist()
            n = pa.array([counter.count(t) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], ["doc_id", "n_bytes", "n_tokens"])

    small_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    """Tokens of every text of documents."""
    return counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
