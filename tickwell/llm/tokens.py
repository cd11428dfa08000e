"""Token counts by way of distinct pre-tokens.

A pre-token is a run of spaces with the word after it; the model's own prefix makes a text
begin with one. ``checked_pieces`` makes sure that no piece of the model holds a space
after anything else, so no merge crosses a pre-token's start, and the tokens of a text are
those of its pre-tokens.

1. The ``head`` most common pre-tokens, none longer than ``longest`` characters, are cut
   into pieces once and their counts go to all tasks (head * longest characters at most,
   whatever the corpus); a document's frequencies of these are summed on the spot.
2. All other pre-tokens are dealt to parts by a hash, with the document's row and its
   frequency, packed per task. A part holds every occurrence of its pre-tokens, cuts each
   into pieces once and joins the counts to the frequencies. As the common ones take no
   part in this, none of its keys is hot.
3. What a part finds goes back to the task's rows it came from and is summed there.

Which pre-tokens are common follows from lists that tasks send of their most common ones;
it decides where a pre-token is counted, not whether. Ids are never kept or sent.

Edge cases: null is the empty text, 0 tokens and 0 bytes. Rows that repeat a doc_id are
counted row by row. Rows with a null doc_id too. Very long words are pre-tokens like any
other. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

import itertools
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import batches_of, stored, utf8

_OTHER = re.compile("[ ▁]+[^ ▁]*")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text that isn't empty, each without its first space."""
    if "▁" not in text and "  " not in text and text[-1] != " " and text[0] != " ":
        return text.split(" ")
    return [p[1:] for p in _OTHER.findall(" " + text)]


@lru_cache(maxsize=4)
def checked_pieces(path: str):
    """The sentencepiece model, if texts may be cut before their spaces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(re.search("[^▁]▁", model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("a piece of this model spans words")
    if model.normalize("  a\ufb01 \n") != "▁▁▁a\ufb01▁\n":
        raise ValueError("this model alters its texts")
    return model


def piece_counts(path: str, words: list[str]) -> list[int]:
    """The pieces of each pre-token. The empty one is a single space at a text's end."""
    model = checked_pieces(path)
    last = len(model.encode("a ")) - len(model.encode("a"))
    return [len(x) if w else last for w, x in zip(words, model.encode(words, num_threads=1), strict=True)] if words else []


def common_pre_tokens(docs: DataFrame, head: int, longest: int) -> tuple[list[str], int]:
    """(the most common pre-tokens, how many there are in all) by the number of rows they occur in."""

    def count(batches):
        seen: Counter = Counter()
        n = 0

        def most():
            # Once in so many texts is not common.
            chosen = [(w, k) for w, k in seen.most_common(4 * head) if k > 1 and len(w) <= longest]
            return [w for w, _ in chosen], [k for _, k in chosen]

        for batch in batches:
            for raw in utf8(batch.column(0)):
                if raw:
                    words = set(pre_tokens(raw.decode()))
                    n += len(words)
                    seen.update(words)
                if len(seen) > 300_000:
                    yield most()
                    seen.clear()
        yield most()
        yield [None], [n]

    def run(batches):
        return batches_of(count(batches), ["word", "n"], [pa.string(), pa.int64()])

    sums = stored(docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "common")
    rows = sums.where("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(head).collect()
    return [r.word for r in rows], sums.where("word IS NULL").agg(F.sum("n")).first()[0] or 0


DEALT = "task long, part int, a binary, b binary, c binary, d binary"
#: Ends a word in a packed list; no UTF-8 text has this byte.
_STOP = b"\xff"


def dealt(docs: DataFrame, common: dict[str, int], parts: int, flush: int = 1_000_000) -> DataFrame:
    """Rows of two kinds, some texts at a time (``task``).

    Without a part: ids and whether they are null, bytes and tokens so far, per text. With a
    part: other pre-tokens, in how many of the texts each is, in which, and how often.
    """
    names = [c.split()[0] for c in DEALT.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 4]

    def deal(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 24
        texts: list[tuple] = []
        held: dict[str, list[int]] = {}
        n = 0

        def packed():
            ids, sizes, sums = zip(*texts, strict=True)
            null = np.array([i is None for i in ids], np.uint8)
            yield [task], [None], [np.array([i or 0 for i in ids], np.int64).tobytes()], [np.array(sizes, np.int64).tobytes()], [np.array(sums, np.int64).tobytes()], [null.tobytes()]
            by_part: dict[int, list[str]] = {}
            for word in held:
                by_part.setdefault(zlib.crc32(word.encode()) % parts, []).append(word)
            for part, words in by_part.items():
                where = [held[w] for w in words]
                flat = np.fromiter(itertools.chain.from_iterable(where), np.uint32)
                sizes = np.fromiter((len(x) // 2 for x in where), np.uint32, len(where))
                yield [task], [part], [_STOP.join(w.encode() for w in words)], [sizes.tobytes()], [flat[::2].tobytes()], [flat[1::2].tobytes()]

        get = common.get
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                total, row = 0, len(texts)
                for word, k in Counter(pre_tokens(raw.decode())).items() if raw else ():
                    if (known := get(word)) is None:
                        held.setdefault(word, []).extend((row, k))
                        n += 1
                    else:
                        total += k * known
                texts.append((doc_id, len(raw), total))
                if n > flush:
                    yield from packed()
                    texts, held, n, task = [], {}, 0, task + 1
        if texts:
            yield from packed()

    def run(batches):
        return batches_of(deal(batches), names, types)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DEALT)


def _counter(path: str):
    def count(part: pd.DataFrame) -> pd.DataFrame:
        """The tokens that a part's pre-tokens add to each text."""
        lists = [[w.decode() for w in a.split(_STOP)] for a in part.a]
        words = list(dict.fromkeys(itertools.chain.from_iterable(lists)))
        pieces = {}
        for i in range(0, len(words), 10_000):
            pieces.update(zip(words[i : i + 10_000], piece_counts(path, words[i : i + 10_000]), strict=True))
        out = []
        for own, r in zip(lists, part.itertuples(), strict=True):
            each = np.repeat(np.array([pieces[w] for w in own], np.int64), np.frombuffer(r.b, np.uint32))
            rows, at = np.unique(np.frombuffer(r.c, np.uint32), return_inverse=True)
            sums = np.bincount(at, weights=each * np.frombuffer(r.d, np.uint32), minlength=len(rows))
            out.append((r.task, rows.tobytes(), sums.astype(np.int64).tobytes()))
        return pd.DataFrame(out, columns=["task", "rows", "sums"])

    return count


def _added(key: tuple, texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    whole = next(texts.itertuples())
    ids, sizes, sums = (np.frombuffer(x, np.int64) for x in (whole.a, whole.b, whole.c))
    sums = sums.copy()
    for r in found.itertuples():
        sums[np.frombuffer(r.rows, np.uint32)] += np.frombuffer(r.sums, np.int64)
    doc_id = pd.Series(ids, dtype="Int64").mask(np.frombuffer(whole.d, np.uint8) == 1)
    return pd.DataFrame({"doc_id": doc_id, "n_bytes": sizes, "n_tokens": sums})


def token_counts(docs: DataFrame, path: str, head: int = 50_000, longest: int = 64, per_part: int = 2_000_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens of each row of ``docs``."""
    words, total = common_pre_tokens(docs, head, longest)
    common = dict(zip(words, piece_counts(path, words), strict=True))
    both = stored(dealt(docs, common, 1 + total // per_part), "dealt")
    found = both.where("part IS NOT NULL").groupBy("part").applyInPandas(_counter(path), "task long, rows binary, sums binary")
    texts = both.where("part IS NULL")
    return texts.groupBy("task").cogroup(found.groupBy("task")).applyInPandas(_added, "doc_id long, n_bytes long, n_tokens long")
