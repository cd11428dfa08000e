"""Text scores by a hierarchical Pitman-Yor language model.

Tokens: words of the text with A-Z in lower case, then one end. A context is what stands
before a token: the text's start or a word, whichever; each word has a restaurant of its own,
however rare. Each context is a Chinese restaurant whose customers are the training tokens seen there and whose dishes
are words; all share one parent restaurant, whose customers are the tables of the contexts
and whose base is uniform over the V known words and one unknown.

Seating is sampled by blocked Gibbs sweeps. All customers of a dish in a restaurant get up at
once and are seated anew given everyone else: the number t of their tables is drawn from its
conditional law, the product of the t new tables' weights, (strength + discount * tables) *
P(parent), times the generalised Stirling number S(n, t) of ways to sit at them (``reseat``).
P(parent) leaves out the customers that the dish itself has sent there. The parent's own
tables follow by the same law. All dishes are seated side by side: what the others hold is
their state of the sweep before. After ``BURN`` sweeps each further one gives predictive
probabilities; their mean over the sweeps is a token's probability, and a text's score
the sum of its log10, from which perplexity follows. Discounts come from the counts of
counts.

At scale: pairs of a context and a word are counted in one of two places, which is no part of
the model. Pairs of the ``TABLE`` most common contexts and the ``HEAD`` most common words are in
a table of a size that doesn't grow, summed by Spark and sent to all tasks. All others are dealt
to blocks, with each of their occurrences: by a hash of the word, if that is not of the head,
else by one of its context, if that is not of the head, else by one of both. So no block is hot,
and a word that is not of the head has all its customers in one block. Sums per word of the head go
through the driver. What a block lacks of another word, its tables as a context, comes by a
shuffle after each sweep: blocks send the tables that they know of to the word's own block,
which adds them up and answers. Only pairs of several customers take part, as one customer has
one table. What a block finds for a text goes back, packed, to the keys of the texts that were
dealt together.
Counts cover every training token, scores every token of every document.

Edge cases: a null text is an empty one: one token, the end. Rows repeated with id and text
are scored each (rows of one id are told apart by a 64-bit hash). A null doc_id is held out.
With no training token N and V are 0 and the one unknown word has all probability. An
empty table gives no rows. Columns other than doc_id and text are not read.
"""

import functools
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import batches_of, stored, utf8

HEAD, TABLE, SWEEPS, BURN, STRENGTH = 8192, 512, 4, 1, 1.0
CONTEXTS = HEAD
EXACT = 512  # customers of a dish
END = b"\n"
DEALT = "task long, part int, words binary, word binary, owner binary, context binary, keys binary, ids binary, code long, n long"
PAIRS = "part int, words long, foreign long, n_pairs long, occurrences long, pair_word binary, pair_context binary, pair_n binary, pair binary, first binary, texts binary, customers binary, several long, word binary"
LINKS = "links array<struct<part:int,names:binary,ones:binary,more:binary,n:bigint>>"
BLOCK = f"{PAIRS}, context binary, n binary, own_words binary, own_contexts binary, of_others binary, n_of_others long, names binary, sums binary, {LINKS}"
WORK = ["part", "words", "foreign", "several", "word", "context", "n", "own_words", "of_others", "n_of_others"]
MAIL = "kind string, sweep int, part int, src int, a binary, b binary, n long"
SUMS = CONTEXTS + 6  # customers per context, then: N, V, pairs of 1, of 2, words of 1, of 2


def tokens_of(raw: bytes) -> list[bytes]:
    return [*raw.lower().split(), END]


def common_words(docs: DataFrame, head: int, kept: int = 4) -> tuple[list[bytes], int]:
    """(most common words, number of words) of rows (text).

    Tasks count all their words and send their ``kept * head`` most common. The words chosen
    decide where a word is counted, not whether, and are no part of the model.
    """

    def count(batches):
        every, n = Counter(), 0

        def most():
            chosen = every.most_common(kept * head)
            return [w for w, _ in chosen], [k for _, k in chosen]

        for batch in batches:
            for raw in utf8(batch.column(0)):
                words = raw.lower().split()
                n += len(words)
                every.update(words)
            if len(every) > 200_000:
                yield most()
                every.clear()
        yield most()
        yield [None], [n]

    def run(batches):
        return batches_of(count(batches), ["word", "n"], [pa.binary(), pa.int64()])

    sums = stored(docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "common")
    every = [bytes(r.word) for r in sums.where("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(head - 1).collect()]
    return every, sums.where("word IS NULL").agg(F.sum("n")).first()[0] or 0


class Coder:
    """Tokens as numbers: the head's places, then, from ``head`` on, those of a vocabulary that grows."""

    def __init__(self, head: list[bytes], size: int, table: int):
        self.place = {w: i for i, w in enumerate([END, *head])}
        self.head, self.table = size, table

    def code(self, tokens: list[bytes], vocabulary: dict[bytes, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(number of each token, or -1, and of the one before it) of texts that all end in END, 0, which also stands for their start."""
        number = np.fromiter(map(self.place.get, tokens, repeat(-1)), np.int64, len(tokens))
        if vocabulary is not None:
            other = np.flatnonzero(number < 0)
            number[other] = [self.head + vocabulary.setdefault(tokens[i], len(vocabulary)) for i in other.tolist()]
        return number, np.r_[0, number[:-1]]


def _array(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(raw, kind)


def _packed(a: np.ndarray) -> bytes:
    """Numbers below 2^32, in as few bytes each as the largest takes, many of them by zstd; the first byte says how."""
    width = 1 if not len(a) or (most := a.max()) <= 0xFF else 2 if most <= 0xFFFF else 4
    raw = a.astype(f"u{width}").tobytes()
    return bytes([width]) + raw if len(raw) < 256 else bytes([width | 8]) + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    width, rest = raw[0] & 7, raw[1:]
    return _array(pa.decompress(rest, int(n) * width, "zstd", asbytes=True) if raw[0] & 8 else rest, f"u{width}").astype(np.int64)


def _zipped(raw: bytes) -> bytes:
    return len(raw).to_bytes(8) + pa.compress(raw, "zstd", asbytes=True)


def _unzipped(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8]), "zstd", asbytes=True)


def _part(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))


def dealt(docs: DataFrame, coder: Coder, parts: int) -> DataFrame:
    """Rows of three kinds, some texts at a time (``task``).

    With a part: occurrences outside the table, packed; the lowest bit of a context marks a
    training text. Without one: the keys of the texts, or how often in training texts a pair of
    the table occurs or, behind these, a word of the head.
    """
    names = [c.split()[0] for c in DEALT.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 6, pa.int64(), pa.int64()]
    head, table = coder.head, coder.table

    def deal(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 12
        counts = np.zeros(table * head + head, np.int64)
        vocabulary: dict[bytes, int] = {}
        held: list[tuple[np.ndarray, ...]] = []
        keys: list[int] = []
        ids: list[int] = []
        size = 0

        def flush():
            nonlocal task, size
            yield [task], *[[None]] * 5, [np.array(keys, np.int64).tobytes()], [np.array(ids, np.int64).tobytes()], [None], [None]
            word, context, owner, seen = (np.concatenate(c) for c in zip(*held, strict=True))
            words = list(vocabulary)
            of_word = np.r_[np.full(head, -1), _part(words, parts)]
            part = of_word[word]
            part = np.where(part < 0, of_word[context], part)
            # Both of the head: such a pair needs nothing that only a block knows, and may go anywhere.
            both = np.flatnonzero(part < 0)
            part[both] = ((context[both] * head + word[both]) * 0x9E3779B1 >> 20) % parts
            order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
            word, context, owner, seen, part = (x[order] for x in (word, context, owner, seen, part))
            edges = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                at = slice(edges[p], edges[p + 1])
                w, u = word[at], context[at]
                used = np.unique(np.r_[w[w >= head], u[u >= head]])
                w, u = (np.where(x >= head, head + np.searchsorted(used, x), x) for x in (w, u))
                joined = _zipped(b" ".join([words[i - head] for i in used.tolist()]))
                yield [task], [p], [joined], [_packed(w)], [_packed(np.diff(owner[at], prepend=0))], [_packed(2 * u + seen[at])], *[[None]] * 3, [len(w)]
            vocabulary.clear()
            held.clear()
            keys.clear()
            ids.clear()
            task, size = task + 1, 0

        for batch in batches:
            for start in range(0, len(batch), 200):
                piece = batch.slice(start, 200)
                each = [tokens_of(raw) for raw in utf8(piece.column(2))]
                if not each:
                    continue
                seen = np.array(piece.column(3).to_pylist(), bool)
                owner = np.repeat(np.arange(len(each)), [len(t) for t in each])
                word, context = coder.code([t for one in each for t in one], vocabulary)
                learnt = seen[owner]
                counts[table * head :] += np.bincount(word[learnt & (word < head)], minlength=head)
                inside = (word < head) & (context < table)
                at = inside & learnt
                code, n = np.unique(context[at] * head + word[at], return_counts=True)
                counts[code] += n
                out = np.flatnonzero(~inside)
                held.append((word[out], context[out], owner[out] + len(keys), learnt[out]))
                size += len(out)
                keys += piece.column(0).to_pylist()
                ids += [i or 0 for i in piece.column(1).to_pylist()]
                if len(vocabulary) > 200_000 or len(keys) > 60_000 or size > 4_000_000:
                    yield from flush()
        if held:
            yield from flush()
        code = np.flatnonzero(counts)
        none = [None] * len(code)
        yield [*[none] * 8, code, counts[code]]

    def run(batches):
        return batches_of(deal(batches), names, types)

    return docs.select("key", "doc_id", "text", "train").mapInArrow(run, DEALT)


def _frame(rows: list, ddl: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in ddl.split(", ")])


def _block(group: pd.DataFrame, head: int, parts: int) -> pd.DataFrame:
    """All occurrences of a part, as numbers that don't depend on how texts were dealt.

    Numbers from ``head`` on: the part's own words by name, then the words of other parts
    that stand before them, by part and name.
    """
    group = group.sort_values("task")
    own_part = int(group.part.iloc[0])
    words = [_unzipped(raw).split() for raw in group.words]
    names = sorted({w for each in words for w in each})
    of_name = _part(names, parts)
    order = np.argsort(np.where(of_name == own_part, -1, of_name), kind="stable")
    names, of_name = [names[i] for i in order.tolist()], of_name[order]
    m = int((of_name == own_part).sum())
    numbers = {w: head + i for i, w in enumerate(names)}
    word, context, owner = [], [], []
    for r, each in zip(group.itertuples(), words, strict=True):
        own = np.r_[np.arange(head), np.array([numbers[w] for w in each], np.int64)]
        n = int(r.n)
        word.append(own[_unpacked(r.word, n)])
        code = _unpacked(r.context, n)
        context.append(2 * own[code >> 1] + (code & 1))
        owner.append((r.task << 24) + np.cumsum(_unpacked(r.owner, n)))
    word, context, owner = (np.concatenate(x) for x in (word, context, owner))
    train, context = context & 1, context >> 1
    size = head + len(names)
    codes, pair = np.unique(word * size + context, return_inverse=True)
    n = np.bincount(pair, weights=train, minlength=len(codes)).astype(np.int64)
    w, u = np.divmod(codes, size)
    own_word, own_context, foreign = w >= head, (u >= head) & (u < head + m), u >= head + m
    of_word = np.bincount(w[own_word] - head, weights=n[own_word], minlength=m).astype(np.int64)
    single, several = n == 1, n > 1

    def added(x, where, size):
        return np.bincount(x[where], minlength=size).astype(np.int64)

    own_words = added(w - head, own_word & single, m)
    constants = [n[own_word].sum(), (of_word > 0).sum(), single.sum(), (n == 2).sum(), (of_word == 1).sum(), (of_word == 2).sum()]
    sums = np.r_[added(u, single & (u < head), head), added(w, single & ~own_word, head), added(u, several & (u < head), head), added(w, several & ~own_word, head), (own_word & (n > 0)).sum(), (of_word > 0).sum(), constants]
    # Words of other parts: how many pairs have one customer in their restaurants here, and which have pairs of more.
    f = len(names) - m
    ones, more = added(u - head - m, foreign & single, f), added(u - head - m, foreign & several, f)
    edges = np.searchsorted(of_name[m:], np.arange(parts + 1))
    links = []
    for q in np.flatnonzero(np.diff(edges)).tolist():
        at = slice(edges[q], edges[q + 1])
        links.append({"part": q, "names": _zipped(b" ".join(names[m + at.start : m + at.stop])), "ones": _packed(ones[at]), "more": _packed(more[at]), "n": at.stop - at.start})
    first = np.r_[True, owner[1:] != owner[:-1]]
    row = {
        "part": own_part, "words": m, "foreign": f, "n_pairs": len(codes), "occurrences": len(pair),
        "pair_word": _packed(w), "pair_context": _packed(u), "pair_n": _packed(n), "pair": _packed(pair), "first": np.packbits(first).tobytes(), "texts": _zipped(np.diff(owner[first], prepend=0).tobytes()),
        "sums": sums.astype(np.int64).tobytes(), "links": links, "names": _zipped(b" ".join(names[:m])), "customers": _packed(of_word),
        "several": int(several.sum()), "word": _packed(w[several]), "context": _packed(u[several]), "n": _packed(n[several]),
        "own_words": _packed(own_words), "own_contexts": _packed(added(u - head, own_context & single, m)), "of_others": _packed(np.flatnonzero(more)),
        "n_of_others": int((more > 0).sum()),
    }
    return pd.DataFrame([row])[[c.split()[0] for c in BLOCK.split(", ")]]



@functools.cache
def log_stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(n, t), 1 <= t <= n <= EXACT: n customers' ways to sit at t tables."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0
    t = np.arange(1, EXACT + 1)
    for n in range(1, EXACT):
        with np.errstate(divide="ignore"):
            out[n + 1, 1:] = np.logaddexp(out[n, :-1], out[n, 1:] + np.log(np.maximum(n - t * discount, 0)))
    return out


def reseat(n: np.ndarray, now: np.ndarray, log_weight, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish with ``n`` customers, drawn given all other seating.

    ``log_weight(rows, i)`` is the logarithm of the weight of table i + 1 of these dishes. The
    law is the product of the weights of t tables times S(n, t), exactly so up to EXACT
    customers. Beyond, tables are Poisson clusters bound to n customers in all: the mean and the
    spread of their number follow from the saddle point, at the weight that the tables there
    are ``now`` have on average.
    """
    tables = np.minimum(n, 1)
    law = log_stirling(discount)
    order = np.argsort(n, kind="stable")
    order = order[np.searchsorted(n[order], 2) :]  # one customer has one table
    large = np.searchsorted(n[order], EXACT, side="right")
    start = 0
    while start < large:
        widest = int(n[order[min(large, start + 4096) - 1]])
        stop = min(large, start + min(4096, 1_000_000 // widest))
        at = order[start:stop]
        width = int(n[at[-1]])
        p = np.cumsum(log_weight(at[:, None], np.arange(width)[None, :]), axis=1) + law[n[at], 1 : width + 1]
        p = np.cumsum(np.exp(p - p.max(axis=1, keepdims=True)), axis=1)
        tables[at] = 1 + (p < rng.random((len(at), 1)) * p[:, -1:]).sum(axis=1)
        start = stop
    at = order[large:]
    if len(at):
        m, weight = n[at].astype(float), np.exp(log_weight(at[:, None], (now[at] // 2)[:, None])[:, 0])
        low, high = np.full(len(at), -700.0), np.zeros(len(at))
        for _ in range(60):  # y = 1 - x with weight * x * y ** (discount - 1) = n, by halving log(y)
            y = (low + high) / 2
            more = np.log(weight) + np.log1p(-np.exp(y)) - (1 - discount) * y > np.log(m)
            low, high = np.where(more, y, low), np.where(more, high, y)
        y = np.exp(low)
        mean = weight * (1 - y**discount) / discount
        spread = m + weight * (1 - y) ** 2 * (1 - discount) * y ** (discount - 2)
        p = np.clip(m * m / (spread * mean), 1e-9, 1 - 1e-9)  # what binding to n takes off a Poisson spread
        trials = np.ceil(mean / p)
        tables[at] = np.clip(1 + rng.binomial(trials.astype(np.int64), mean / trials), 1, n[at])
    return tables


class Model:
    """Constants of the corpus and, per sweep so far, its sums: tables per context, the parent's customers and tables."""

    def __init__(self, sums: np.ndarray):
        self.customers = sums[:-6].astype(float)
        self.n, self.v, one, two, word_one, word_two = (int(x) for x in sums[-6:])
        self.low = min(0.95, max(0.05, one / max(1, one + 2 * two)))
        self.high = min(0.95, max(0.05, word_one / max(1, word_one + 2 * word_two)))
        self.sweeps: list[np.ndarray] = []

    def base(self, customers: np.ndarray) -> np.ndarray:
        return np.log10((customers + 1) / (self.n + self.v + 1))

    def seat(self, w, n, t, tables, diners, top, all_diners, all_top, rng) -> np.ndarray:
        """New tables of pairs whose words ``w`` have ``diners`` at ``top`` tables of the parent, in contexts of ``tables`` each."""
        fresh = (STRENGTH + self.high * all_top) / (self.v + 1)
        # What remains without the customers of the dish that are to be seated anew.
        own = np.maximum(tables - t, 0)
        diners = np.maximum(diners[w] - t, 0)
        held = np.minimum(top[w], diners)
        total = STRENGTH + np.maximum(all_diners - t, diners)

        def of_context(rows, i):
            there = diners[rows] + i
            parent = (np.maximum(there - self.high * np.maximum(held[rows], there > 0), 0) + fresh) / (total[rows] + i)
            return np.log((STRENGTH + self.low * (own[rows] + i)) * parent)

        return reseat(n, t, of_context, self.low, rng)

    def seat_above(self, diners, top, all_top, rng) -> np.ndarray:
        """New tables of words in the parent."""
        others = np.maximum(all_top - top, 0)
        return reseat(diners, top, lambda rows, i: np.log((STRENGTH + self.high * (others[rows] + i)) / (self.v + 1)), self.high, rng)

    def parent(self, diners, top, all_diners, all_top) -> np.ndarray:
        """P of words in the parent."""
        return (diners - self.high * top + (STRENGTH + self.high * all_top) / (self.v + 1)) / (STRENGTH + all_diners)

    def probability(self, n, t, tables, customers, parent) -> np.ndarray:
        """P of pairs."""
        return (np.maximum(0, n - self.low * t) + (STRENGTH + self.low * tables) * parent) / (STRENGTH + customers)

    def sample(self, word: np.ndarray, context: np.ndarray, n: np.ndarray, words: int, seed: int):
        """All customers in one place: per sweep, its sums, and P of each pair once the sums of all places are known."""
        rng = np.random.default_rng(seed)
        at = np.flatnonzero(n)
        w, u, customers = word[at], context[at], n[at]
        t = np.ones(len(at), np.int64)
        top = (np.bincount(w, minlength=words) > 0).astype(np.int64)
        tables, all_diners, all_top = self.customers / 2, self.customers.sum() / 2, self.v
        for sweep in range(len(self.sweeps) + 1):
            diners = np.bincount(w, weights=t, minlength=words).astype(np.int64)
            t = self.seat(w, customers, t, tables[u], diners, top, all_diners, all_top, rng)
            diners = np.bincount(w, weights=t, minlength=words).astype(np.int64)
            top = self.seat_above(diners, top, all_top, rng)
            sums = np.r_[np.bincount(u, weights=t, minlength=len(self.customers)), diners.sum(), top.sum()]
            if sweep == len(self.sweeps):
                yield sums, None
                return
            tables, all_diners, all_top = self.sweeps[sweep][:-2], *self.sweeps[sweep][-2:]
            parent = self.parent(diners, top, all_diners, all_top)
            all_t = np.zeros(len(n), np.int64)
            all_t[at] = t
            yield sums, lambda t=all_t, tables=tables, parent=parent: self.probability(n, t, tables[context], self.customers[context], parent[word])

    def sums(self, *block) -> np.ndarray:
        """A block's sums of the sweep to come."""
        *_, (own, _) = self.sample(*block)
        return own

    def log_probabilities(self, word, context, n, words, seed) -> np.ndarray:
        """Of each pair, the mean over the sweeps after BURN."""
        kept = [p() for _, p in self.sample(word, context, n, words, seed) if p is not None][BURN:]
        return np.log10(sum(kept) / len(kept))


class State:
    """What a sweep leaves for all places: per word of the head, its tables as a context, its customers and tables in the parent; sums."""

    def __init__(self, tables: np.ndarray, diners: np.ndarray, top: np.ndarray, own_diners: float, own_top: float):
        self.tables, self.diners, self.top = tables, diners, top
        self.all_diners, self.all_top = diners.sum() + own_diners, top.sum() + own_top


def _added(rows: DataFrame, size: int) -> np.ndarray:
    """The sum, place by place, of the rows' arrays ``a`` of 64-bit numbers."""

    def add(groups):
        total = np.zeros(size, np.int64)
        for group in groups:
            for raw in group.a:
                total += _array(raw, np.int64)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"i": at, "x": total[at]})

    summed = rows.select("a").mapInPandas(add, "i long, x long").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(size, np.int64)
    out[summed["i"].to_numpy()] = summed["x"].to_numpy()
    return out


def _linked(work: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
    """What a part tells others of its words: their numbers, by name, and the tables of a first state with one per pair."""
    r = next(work.itertuples())
    numbers = {w: i for i, w in enumerate(_unzipped(r.names).split())}
    m = len(numbers)
    whole, out, sent = _unpacked(r.own_contexts, m), [], []
    context = _unpacked(r.context, r.several)
    near = context[(context >= r.head) & (context < r.head + m)] - r.head
    first = np.bincount(near, minlength=m)
    for x in mail.itertuples():
        at = np.array([numbers[w] for w in _unzipped(x.names).split()], np.int64)
        more = _unpacked(x.more, x.n)
        whole[at] += _unpacked(x.ones, x.n)
        first[at] += more
        out.append(("numbers", 0, r.part, x.src, _packed(at), None, len(at)))
        sent.append((x.src, at[more > 0]))
    first = first + whole
    for src, at in sent:
        out.append(("link", 0, src, r.part, _packed(at), None, len(at)))
        out.append(("reply", -1, src, r.part, _packed(first[at]), None, len(at)))
    out += [("whole", 0, r.part, r.part, _packed(whole), None, m), ("tables", -1, r.part, r.part, _packed(first), None, m)]
    return _frame(out, MAIL)


def _stepped(work: pd.DataFrame, mail: pd.DataFrame, model: Model, state: State, head: int, sweep: int) -> pd.DataFrame:
    """A sweep over the pairs of a part that have more than one customer; others have one table."""
    r = next(work.itertuples())
    m, part = int(r.words), int(r.part)
    by = {kind: list(rows.sort_values("src").itertuples()) for kind, rows in mail.groupby("kind")}
    w, u, n = (_unpacked(x, r.several) for x in (r.word, r.context, r.n))
    own_words = _unpacked(r.own_words, m)
    near = w >= head
    if "state" in by:
        t, top = _unpacked(by["state"][0].a, r.several), _unpacked(by["state"][0].b, m)
    else:
        t, top = np.ones(r.several, np.int64), (_unpacked(r.customers, m) > 0).astype(np.int64)
    of_others = _unpacked(r.of_others, r.n_of_others)
    tables = np.r_[state.tables, _unpacked(by["tables"][0].a, m), np.zeros(r.foreign, np.int64)]
    tables[head + m + of_others] = np.concatenate([np.zeros(0, np.int64), *[_unpacked(x.a, x.n) for x in by.get("reply", [])]])

    def own_diners(t):
        return own_words + np.bincount(w[near] - head, weights=t[near], minlength=m).astype(np.int64)

    rng = np.random.default_rng([part + 1, sweep])
    t = model.seat(w, n, t, tables[u], np.r_[state.diners, own_diners(t)], np.r_[state.top, top], state.all_diners, state.all_top, rng)
    diners = own_diners(t)
    top = model.seat_above(diners, top, state.all_top, rng)
    there = np.bincount(u, weights=t, minlength=head + m + r.foreign).astype(np.int64)
    sums = np.r_[there[:head], np.bincount(w[~near], weights=t[~near], minlength=head).astype(np.int64), diners.sum(), top.sum()]
    out = [("state", sweep, part, part, _packed(t), _packed(top), m), ("sums", sweep, part, part, sums.astype(np.int64).tobytes(), None, 0)]
    out.append(("own", sweep, part, part, _packed(_unpacked(by["whole"][0].a, m) + there[head : head + m]), None, m))
    told, start = there[head + m + of_others], 0
    for x in by.get("link", []):
        out.append(("to", sweep, int(x.src), part, x.a, _packed(told[start : start + x.n]), int(x.n)))
        start += x.n
    return _frame(out, MAIL)


def _answered(mail: pd.DataFrame) -> pd.DataFrame:
    """The tables of a part's words as contexts, over all parts, sent back to those that know some of them."""
    (own,) = mail[mail.kind == "own"].itertuples()
    tables = _unpacked(own.a, own.n).copy()
    others = [(x.src, _unpacked(x.a, x.n), _unpacked(x.b, x.n)) for x in mail[mail.kind == "to"].itertuples()]
    for _, at, t in others:
        tables[at] += t
    out = [("reply", own.sweep, src, own.part, _packed(tables[at]), None, len(at)) for src, at, _ in others]
    return _frame([*out, ("tables", own.sweep, own.part, own.part, _packed(tables), None, own.n)], MAIL)


def _finals(work: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
    """To each part that knows some of a part's words: their customers, and their tables after each sweep."""
    r = next(work.itertuples())
    customers = _unpacked(r.customers, r.words)
    tables = [(x.sweep, _unpacked(x.a, x.n)) for x in mail[mail.kind == "tables"].itertuples()]
    out = []
    for x in mail[mail.kind == "numbers"].itertuples():
        at = _unpacked(x.a, x.n)
        out += [("final", sweep, x.src, r.part, _packed(customers[at]), _packed(t[at]), len(at)) for sweep, t in tables]
    return _frame(out, MAIL)


def scores(docs: DataFrame, training: Column, per_part: int = 1_500_000, head: int = HEAD, table: int = TABLE) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row; learnt where ``training`` holds.

    ``head`` and ``table`` say where pairs are counted; neither is part of the model.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("key"), training.alias("train"))
    common, total = common_words(rows, head)
    table = min(table, head)
    coder = Coder(common, head, table)
    # Blocks of so many words of the corpus; the table's, many of them, are in none.
    parts = 1 + total // per_part
    both = stored(dealt(rows, coder, parts), "dealt", "zstd")
    blocks = stored(both.where("part IS NOT NULL").groupBy("part").applyInPandas(lambda group: _block(group, head, parts), BLOCK), "blocks", "zstd")
    counts = np.zeros(table * head + head, np.int64)
    summed = both.where("code IS NOT NULL").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts[summed["code"].to_numpy()] = summed["n"].to_numpy()
    counts, of_word = counts[: table * head], counts[table * head :]
    pairs = np.flatnonzero(counts)
    n = counts[pairs]
    single, double = (n == 1).sum(), (n == 2).sum()
    once, (context, word) = np.divmod(pairs[n == 1], head), np.divmod(pairs[n > 1], head)
    pairs, n = pairs[n > 1], n[n > 1]
    first = _added(blocks.select(F.col("sums").alias("a")), 4 * head + 8)
    ones, others = first[: 2 * head].reshape(2, head), first[2 * head : 4 * head].reshape(2, head)
    own_diners, own_top, *constants = first[4 * head :]
    constants = np.array(constants) + [of_word.sum(), (of_word > 0).sum(), single, double, (of_word == 1).sum(), (of_word == 2).sum()]
    model = Model(np.r_[of_word, constants])
    ones += [np.bincount(x, minlength=head) for x in once]

    def state_of(t, top, others, own_diners, own_top):
        """Of tables ``t`` in the table and what the blocks sent."""
        there = [np.bincount(x, weights=t, minlength=head).astype(np.int64) for x in (context, word)]
        tables, diners = ones + others + there
        return State(tables, diners, top(diners), own_diners, own_top)

    def step(state, sweep):
        return lambda own, mail: _stepped(own, mail, model, state, head, sweep)

    rng = np.random.default_rng(0)
    t = np.ones(len(n), np.int64)
    states = [state_of(t, lambda diners: np.minimum(diners, 1), others, own_diners, own_top)]
    seated = []
    work = blocks.select(*WORK, "customers")
    links = blocks.select(F.col("part").alias("src"), F.explode("links").alias("l")).select("src", "l.*")
    named = blocks.select("part", "names", "context", "several", "own_contexts", F.lit(head).alias("head"))
    mail = linked = stored(named.groupBy("part").cogroup(links.groupBy("part")).applyInPandas(_linked, MAIL), "linked")
    constant = linked.where("kind IN ('link', 'whole')")
    history = []

    for sweep in range(SWEEPS):
        state = states[-1]
        told = constant.unionByName(mail.where("kind IN ('reply', 'tables', 'state')"))
        stepped = stored(work.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(step(state, sweep), MAIL), "stepped")
        t = model.seat(word, n, t, state.tables[context], state.diners, state.top, state.all_diners, state.all_top, rng)
        sums = _added(stepped.where("kind = 'sums'"), 2 * head + 2)
        states.append(state_of(t, lambda diners, state=state: model.seat_above(diners, state.top, state.all_top, rng), sums[: 2 * head].reshape(2, head), *sums[2 * head :]))
        seated.append(t)
        answers = stored(stepped.where("kind IN ('own', 'to')").groupBy("part").applyInPandas(_answered, MAIL), "answers")
        mail = answers.unionByName(stepped.where("kind = 'state'"))
        if sweep >= BURN:
            history.append(mail.where("kind IN ('tables', 'state')"))

    # Per sweep that counts: tables of the head's contexts, P of its words in the parent, sums.
    ends = [(s.tables, model.parent(s.diners, s.top, s.all_diners, s.all_top), s.all_diners, s.all_top) for s in states[1 + BURN :]]
    log_table = np.zeros(table * head, np.float32)
    for u in range(table):
        at = slice(u * head, (u + 1) * head)
        own = slice(*np.searchsorted(pairs, [at.start, at.stop]))
        p = np.zeros(head)
        for (tables, parent, _, _), t in zip(ends, seated[BURN:], strict=True):
            whole = np.minimum(counts[at], 1)
            whole[pairs[own] - at.start] = t[own]
            p += model.probability(counts[at], whole, tables[u], model.customers[u], parent)
        log_table[at] = np.log10(p / len(ends))
    base_table = model.base(of_word)
    past = functools.reduce(DataFrame.unionByName, history)
    numbers = linked.where("kind = 'numbers'").unionByName(past.where("kind = 'tables'"))
    finals = blocks.select("part", "words", "customers").groupBy("part").cogroup(numbers.groupBy("part")).applyInPandas(_finals, MAIL)

    def probabilities(r, mail: pd.DataFrame) -> tuple[np.ndarray, ...]:
        """Of a block's pairs: word, context, log10 P."""
        m, f = int(r.words), int(r.foreign)
        w, u, n = (_unpacked(x, r.n_pairs) for x in (r.pair_word, r.pair_context, r.pair_n))
        several, near = n > 1, w >= head
        total = np.zeros(len(n))
        for i, (head_tables, parent, all_diners, all_top) in enumerate(ends):
            by = {kind: list(x.sort_values("src").itertuples()) for kind, x in mail[mail.sweep == BURN + i].groupby("kind")}
            t = (n > 0).astype(np.int64)
            t[several] = _unpacked(by["state"][0].a, r.several)
            diners = np.bincount(w[near] - head, weights=t[near], minlength=m)
            parent = np.r_[parent, model.parent(diners, _unpacked(by["state"][0].b, m), all_diners, all_top)]
            far = by.get("final", [])
            tables = np.concatenate([head_tables, _unpacked(by["tables"][0].a, m), *[_unpacked(x.b, x.n) for x in far]])
            customers = np.concatenate([model.customers, _unpacked(r.customers, m), *[_unpacked(x.a, x.n) for x in far]])
            assert len(tables) == head + m + f
            total += model.probability(n, t, tables[u], customers[u], parent[w])
        return w, n, np.log10(total / len(ends))

    def of_blocks(block: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        """A block's sums per text, packed per task that dealt the text."""
        r = next(block.itertuples())
        w, n, log_p = probabilities(r, mail)
        near = w >= head
        # What concerns a word of the head alone is known without the blocks.
        known = np.r_[np.zeros(head, np.int64), _unpacked(r.customers, r.words)][w]
        pair, texts = _unpacked(r.pair, r.occurrences), np.cumsum(_array(_unzipped(r.texts), np.int64))
        owner = np.cumsum(np.unpackbits(_array(r.first, np.uint8), count=r.occurrences)) - 1
        sums = [
            np.bincount(owner, weights=x[pair], minlength=len(texts)).astype(kind)
            for x, kind in (((known > 0).astype(float), np.int64), (np.where(near, model.base(known), 0), np.float64), (log_p, np.float32))
        ]
        task = texts >> 24
        starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
        own = [slice(a, b) for a, b in zip(starts, np.r_[starts[1:], len(texts)], strict=True)]
        place = texts & 0xFFFFFF
        return pd.DataFrame([(task[at.start], at.stop - at.start, _packed(place[at]), _packed(sums[0][at]), *(x[at].tobytes() for x in sums[1:])) for at in own], columns=["task", "texts", "place", *names[5:]])

    def added(texts: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        """What the blocks found for the texts of a task."""
        one = next(texts.itertuples())
        keys, ids = _array(one.keys, np.int64), _array(one.ids, np.int64)
        out = {c: np.zeros(len(keys)) for c in names[5:]}
        for r in packed.itertuples():
            place = _unpacked(r.place, r.texts)
            out["n_known"][place] += _unpacked(r.n_known, r.texts)
            out["base_score"][place] += _array(r.base_score, np.float64)
            out["score"][place] += _array(r.score, np.float32)
        return pd.DataFrame({"key": keys, "id": ids, "doc_id": pd.array([None] * len(keys), "Int64"), "copies": 0, "n_tokens": 0} | out | {"n_known": out["n_known"].astype(np.int64)})

    def of_rows(batches):
        for batch in batches:
            for start in range(0, len(batch), 200):
                piece = batch.slice(start, 200)
                each = [tokens_of(raw) for raw in utf8(piece.column(3))]
                if not each:
                    continue
                sizes = [len(t) for t in each]
                owner = np.repeat(np.arange(len(each)), sizes)
                word, before = coder.code([t for one in each for t in one])
                of_head = word >= 0
                inside = of_head & (before >= 0) & (before < table)
                sums = [np.bincount(owner[of_head], weights=x[word[of_head]], minlength=len(each)) for x in ((of_word > 0).astype(float), base_table)]
                sums.append(np.bincount(owner[inside], weights=log_table[before[inside] * head + word[inside]], minlength=len(each)))
                columns = [pa.array([1] * len(each), pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums[0].astype(np.int64)), *[pa.array(x.astype(float)) for x in sums[1:]]]
                yield pa.RecordBatch.from_arrays([*piece.columns[:3], *columns], names=names)

    names = ["key", "id", "doc_id", "copies", "n_tokens", "n_known", "base_score", "score"]
    schema = "key long, id long, doc_id long, copies long, n_tokens long, n_known long, base_score double, score double"
    whole_blocks = blocks.select("part", "words", "foreign", "n_pairs", "occurrences", "pair_word", "pair_context", "pair_n", "pair", "first", "texts", "customers", "several")
    found = whole_blocks.groupBy("part").cogroup(past.unionByName(finals).groupBy("part")).applyInPandas(of_blocks, "task long, texts long, place binary, n_known binary, base_score binary, score binary")
    texts = both.where("keys IS NOT NULL").select("task", "keys", "ids")
    others = texts.groupBy("task").cogroup(found.groupBy("task")).applyInPandas(added, schema)
    parts_of = rows.select("key", F.coalesce("doc_id", F.lit(0)).alias("id"), "doc_id", "text").mapInArrow(of_rows, schema).unionByName(others)
    # Rows with one id and one hash are one text, as often as it occurs.
    whole = parts_of.groupBy("key", "id").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in names[3:]])
    each = [(F.col(c) / F.col("copies")).cast("long" if c.startswith("n_") else "double").alias(c) for c in names[4:]]
    return whole.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", F.lit(model.n).cast("long").alias("train_tokens"), *each)
