"""Encoding into vocabulary pieces by sampling from the piece lattice; decoding.

The lattice of a text has an edge for each piece that stands at a place; a
character that no piece of one character covers gets an edge to its UTF-8 bytes.
A path's weight is the product of its pieces' weights to the power `alpha`.
Forward filtering sums the weights of all paths to each place; backward sampling
draws the piece that ends a text, then the one before it, and so on, so that a
segmentation is drawn with just its share of the whole weight.

Random numbers are a hash of (seed, row key, unit in the row, step): a row's
result doesn't depend on partitions, on other rows or on when it is computed.

No piece has a word mark after another character, and a character in no piece of
two or more stands alone; so texts fall into units (a word with the space before
it, or one such character) that are independent in the lattice.  The forward
step is done once for each different unit of a slice, the backward step for all
occurrences at once.

A space is the word mark; the mark itself, where a text has it, is spelled in
bytes, so decoding gives back every text exactly.  Nothing is normalised.

Edge cases: a null text has null token_ids, n_tokens 0, and decodes to null; an
empty one has no tokens; rows with equal key and text get equal tokens; a null
key counts as 0.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import seqhash as sh
from plumbline.llm.common import Work, batch, map_batches, table

ALPHA, SEED = 0.5, 20240601
MARK, SPACE = 0x2581, 0x20
#: Stands for a word mark in the text itself, which is spelled in bytes.
LITERAL_MARK = 0x110000
SLICE = 1 << 20
#: Units longer than this are filtered one by one.
LONG_UNIT = 48
#: Places of a long unit whose edges are held at once.
PLACES = 1 << 14


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


class Pieces:
    """The pieces of a model: weights, and lookups by hash of characters."""

    def __init__(self, path: str, alpha: float) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        scores = np.array([model.get_score(i) for i in range(n)])
        byte = np.array([model.is_byte(i) for i in range(n)])
        plain = np.array([not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)])
        # Merge models score a piece by minus its rank: weigh it as 1 / (rank + 1).
        ranked = plain.any() and np.all(scores[plain] == np.round(scores[plain])) and scores[plain].min() < -100
        self.log_weight = (alpha * (-np.log1p(np.maximum(-scores, 0)) if ranked else scores)).astype(np.float64)
        self.byte_id = np.full(256, -1, dtype=np.int64)
        for i in np.flatnonzero(byte):
            self.byte_id[int(names[i][3:5], 16)] = i
        if (self.byte_id < 0).any():
            raise ValueError("the model must have a piece for each byte")
        self.unknown_log_weight = float(self.log_weight[plain].min()) - alpha * 5
        self.char_id = np.full(LITERAL_MARK + 1, -1, dtype=np.int32)
        self.in_longer = np.zeros(LITERAL_MARK + 1, dtype=bool)
        chars, ends, ids = [], [0], []
        self.longest = 1
        for i in np.flatnonzero(plain):
            c = [ord(x) for x in names[i]]
            if MARK in c[1:] and any(x != MARK for x in c[: len(c) - c[::-1].index(MARK)]):
                raise ValueError("a piece has a word mark after another character")
            if len(c) == 1:
                self.char_id[c[0]] = i
            else:
                self.in_longer[c] = True
                self.longest = max(self.longest, len(c))
                chars += c
                ends.append(len(chars))
                ids.append(i)
        ends = np.array(ends)
        rolling = sh.Rolling(char_values(np.array(chars, dtype=np.uint32)))
        keys = rolling.hash(ends[:-1], ends[1:])
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids, dtype=np.int64)[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        texts = [bytes([int(names[i][3:5], 16)]) if byte[i] else (names[i].replace(chr(MARK), " ").encode() if plain[i] else b"") for i in range(n)]
        self.flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.size = np.array([len(t) for t in texts], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the keys that are pieces, and their ids."""
        at = np.flatnonzero(self.maybe[(keys >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        ok = self.keys[k] == keys[at]
        return at[ok], self.ids[k[ok]]


@lru_cache(maxsize=4)
def pieces(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


def char_values(chars: np.ndarray) -> np.ndarray:
    return sh.mix(chars.astype(np.uint64) + np.uint64(0x51ED270B))


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, spaces as marks, and the rows' offsets in them."""
    chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    literal = chars == MARK
    chars[chars == SPACE] = MARK
    chars[literal] = LITERAL_MARK
    return chars, before[offsets]


def _units(p: Pieces, chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units start."""
    longer, mark = p.in_longer[chars], chars == MARK
    cut = np.empty(len(chars), dtype=bool)
    cut[:1] = True
    cut[1:] = ~longer[1:] | ~longer[:-1] | (mark[1:] & ~mark[:-1])
    inner = offsets[1:-1]
    cut[inner[inner < len(chars)]] = True
    return np.flatnonzero(cut)


class _Lattice:
    """Edges that end at each place of each unit, with cumulative shares."""

    def __init__(self, p: Pieces, chars: np.ndarray, rolling: sh.Rolling, start: np.ndarray, size: np.ndarray) -> None:
        # Units by falling size: those that reach place q are the first so many.
        self.order = np.argsort(-size, kind="stable")
        start, size = start[self.order], size[self.order]
        top = int(size[0])
        reach = np.searchsorted(-size, -np.arange(top + 1), side="right")
        self.node = np.concatenate([[0, 0], np.cumsum(reach[1:])])[: top + 1]
        forward = np.full((len(size), top + 1), -np.inf)
        forward[:, 0] = 0
        cums, ids, lens, counts = [], [], [], []
        for q in range(1, top + 1):
            n, most = int(reach[q]), min(p.longest, q)
            weight = np.full((n, most), -np.inf)
            piece = np.zeros((n, most), dtype=np.int32)
            end = start[:n] + q
            c = chars[end - 1]
            one = p.char_id[c]
            weight[:, 0] = np.where(one >= 0, p.log_weight[one], p.unknown_log_weight) + forward[:n, q - 1]
            piece[:, 0] = np.where(one >= 0, one, -1 - c.astype(np.int64))
            for width in range(2, most + 1):
                at, found = p.find(rolling.hash(end - width, end))
                weight[at, width - 1] = p.log_weight[found] + forward[at, q - width]
                piece[at, width - 1] = found
            best = weight.max(axis=1)
            share = np.exp(weight - best[:, None])
            total = np.cumsum(share, axis=1)
            forward[:n, q] = best + np.log(total[:, -1])
            row, col = np.nonzero(share > 0)
            cum = total[row, col] / total[row, -1]
            last = np.append(row[1:] != row[:-1], True)
            cum[last] = 2.0
            cums.append(cum)
            ids.append(piece[row, col])
            lens.append((col + 1).astype(np.int32))
            counts.append(np.bincount(row, minlength=n))
        self.cum, self.ids, self.lens = np.concatenate(cums), np.concatenate(ids), np.concatenate(lens)
        counts = np.concatenate(counts)
        self.first = np.cumsum(counts) - counts
        self.size = size

    def sample(self, unit: np.ndarray, seeds: np.ndarray):
        """(occurrence, step, token) arrays; unit: index in falling size."""
        place = self.size[unit].copy()
        active = np.arange(len(unit))
        step = 0
        while len(active):
            edge = self.first[self.node[place[active]] + unit[active]]
            u = draw(seeds[active], step)
            late = np.flatnonzero(u >= self.cum[edge])
            while len(late):
                edge[late] += 1
                late = late[u[late] >= self.cum[edge[late]]]
            yield active, step, self.ids[edge]
            place[active] -= self.lens[edge]
            active = active[place[active] > 0]
            step += 1


def draw(seeds: np.ndarray, step) -> np.ndarray:
    mixed = sh.mix(seeds + np.asarray(step, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return (mixed >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def _long_unit(p: Pieces, chars: np.ndarray, rolling: sh.Rolling, start: int, size: int, seed: np.uint64) -> np.ndarray:
    """One long unit: the same two passes, place by place.  Edges are made for some
    places at a time, and anew on the way back, so memory grows by the forward sums
    alone (eight bytes a character)."""

    def edges(lo: int, hi: int) -> list[list[tuple[int, int, float]]]:
        """(width, token, log weight) of the pieces that end at places lo + 1 to hi."""
        ends = start + np.arange(lo + 1, hi + 1)
        one = p.char_id[chars[ends - 1]]
        weight = np.where(one >= 0, p.log_weight[one], p.unknown_log_weight)
        token = np.where(one >= 0, one, -1 - chars[ends - 1].astype(np.int64))
        out = [[(1, t, w)] for t, w in zip(token.tolist(), weight.tolist())]
        for width in range(2, min(p.longest, hi) + 1):
            first = max(0, width - 1 - lo)
            at, found = p.find(rolling.hash(ends[first:] - width, ends[first:]))
            for k, i in zip((at + first).tolist(), found.tolist()):
                out[k].append((width, i, float(p.log_weight[i])))
        return out

    def sums(mine, q: int) -> tuple[list[float], float, float]:
        w = [x[2] + forward[q - x[0]] for x in mine]
        best, total, cum = max(w), 0.0, []
        for x in w:
            total += math.exp(x - best) if x != best else 1.0
            cum.append(total)
        return cum, best, total

    forward = np.zeros(size + 1)
    for lo in range(0, size, PLACES):
        for q, mine in enumerate(edges(lo, min(lo + PLACES, size)), lo + 1):
            _, best, total = sums(mine, q)
            forward[q] = best + math.log(total)
    out, q, step, lo = [], size, 0, size
    while q:
        if q <= lo:
            lo = max(0, q - PLACES)
            held = edges(lo, q)
            u = draw(np.full(PLACES, seed, dtype=np.uint64), np.arange(step, step + PLACES, dtype=np.uint64)).tolist()
            since = step
        mine = held[q - lo - 1]
        cum, _, total = sums(mine, q)
        pick = next((k for k, c in enumerate(cum) if u[step - since] < c / total), len(cum) - 1)
        out.append(mine[pick][1])
        q -= mine[pick][0]
        step += 1
    return np.array(out[::-1], dtype=np.int64)


def encode_rows(p: Pieces, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all rows, side by side, and the rows' offsets in them."""
    n_rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, dtype=np.int32), np.zeros(n_rows + 1, dtype=np.int64)
    chars, rows = _characters(data, offsets)
    starts = _units(p, chars, rows)
    sizes = np.diff(np.append(starts, len(chars)))
    row_of = np.searchsorted(rows, starts, side="right") - 1
    ordinal = (np.arange(len(starts)) - np.searchsorted(starts, rows)[row_of]).astype(np.uint64)
    row_seed = sh.mix(keys.astype(np.int64).view(np.uint64) ^ sh.mix(np.array([seed], dtype=np.uint64))[0])
    seeds = sh.mix(row_seed[row_of] + ordinal * np.uint64(0x9E3779B97F4A7C15))
    rolling = sh.Rolling(char_values(chars))
    _, first, kind = np.unique(rolling.hash(starts, starts + sizes), return_index=True, return_inverse=True)
    where, steps, tokens = [], [], []
    counts = np.zeros(len(starts), dtype=np.int64)
    low = 0
    for high in (4, 8, 12, 16, 24, LONG_UNIT):
        mine = np.flatnonzero((sizes[first] > low) & (sizes[first] <= high))
        low = high
        if not len(mine):
            continue
        lattice = _Lattice(p, chars, rolling, starts[first[mine]], sizes[first[mine]])
        rank = np.full(len(first), -1, dtype=np.int64)
        rank[mine[lattice.order]] = np.arange(len(mine))
        occurrences = np.flatnonzero(rank[kind] >= 0)
        for active, step, token in lattice.sample(rank[kind[occurrences]], seeds[occurrences]):
            at = occurrences[active]
            where.append(at)
            steps.append(np.full(len(at), step, dtype=np.int32))
            tokens.append(token)
            counts[at] += 1
    for at in np.flatnonzero(sizes > LONG_UNIT):
        found = _long_unit(p, chars, rolling, int(starts[at]), int(sizes[at]), seeds[at])
        where.append(np.full(len(found), at))
        steps.append(np.arange(len(found) - 1, -1, -1, dtype=np.int32))
        tokens.append(found.astype(np.int32))
        counts[at] = len(found)
    before = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), dtype=np.int32)
    for at, step, token in zip(where, steps, tokens):
        out[before[at] + counts[at] - 1 - step] = token
    row_offsets = np.append(before, len(out))[np.searchsorted(starts, rows)]
    if (out < 0).any():
        out, row_offsets = _spelled(p, out, row_offsets)
    return out, row_offsets


def _spelled(p: Pieces, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece (-1 - code point) become their bytes' pieces."""
    at = np.flatnonzero(tokens < 0)
    kinds, which = np.unique(-1 - tokens[at].astype(np.int64), return_inverse=True)
    texts = [chr(MARK if c == LITERAL_MARK else c).encode("utf-8", "surrogatepass") for c in kinds.tolist()]
    width = np.ones(len(tokens), dtype=np.int64)
    width[at] = np.array([len(t) for t in texts])[which]
    ends = np.concatenate([[0], np.cumsum(width)])
    out = np.repeat(tokens, width)
    longest = max(len(t) for t in texts)
    spelled = np.full((len(texts), longest), -1, dtype=np.int64)
    for k, t in enumerate(texts):
        spelled[k, : len(t)] = p.byte_id[list(t)]
    for k in range(longest):
        has = spelled[which, k] >= 0
        out[ends[at[has]] + k] = spelled[which[has], k]
    return out, ends[offsets]


def decode_rows(p: Pieces, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows, side by side, and the rows' offsets in them."""
    size = p.size[tokens]
    ends = np.concatenate([[0], np.cumsum(size)])
    out = p.flat[np.repeat(p.start[tokens] - ends[:-1], size) + np.arange(ends[-1])]
    return out, ends[offsets]


def _int_lists(tokens: np.ndarray, offsets: np.ndarray, valid: np.ndarray) -> pa.Array:
    nulls = None if valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little"))
    return pa.Array.from_buffers(pa.list_(pa.int32()), len(offsets) - 1, [nulls, pa.py_buffer(offsets.astype(np.int32))], children=[pa.array(tokens.astype(np.int32))])


def encode(docs: DataFrame, model: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """docs with token_ids, n_tokens and lossless (whether decoding the tokens
    gives back the text).  Rows are keyed by doc_id."""
    path = model or default_model()
    kept = [c for c in docs.columns if c not in ("token_ids", "n_tokens", "lossless")]

    def run(b: pa.RecordBatch):
        p = pieces(path, alpha)
        texts = b.column("text")
        keys = b.column("doc_id").cast(pa.int64()).fill_null(0).to_numpy()
        data, offsets = sh.text_buffer(texts)
        valid = texts.is_valid().to_numpy(zero_copy_only=False)
        for lo, hi in sh.row_slices(offsets, SLICE):
            d, o = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            tokens, at = encode_rows(p, d, o, keys[lo:hi], seed)
            back, ends = decode_rows(p, tokens, at)
            wrong = np.concatenate([[0], np.cumsum(back != d)]) if len(back) == len(d) else None
            same = (ends[1:] == o[1:]) & (wrong[o[1:]] == wrong[o[:-1]]) if wrong is not None else np.array([back[ends[i] : ends[i + 1]].tobytes() == d[o[i] : o[i + 1]].tobytes() for i in range(hi - lo)])
            part = b.slice(lo, hi - lo)
            yield batch(**{c: part.column(c) for c in kept}, token_ids=_int_lists(tokens, at, valid[lo:hi]), n_tokens=np.diff(at), lossless=same)

    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", token_ids array<int>, n_tokens long, lossless boolean"
    return map_batches(docs.select(*kept), run, schema)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and decoded (text) of every row of encoded (doc_id, token_ids)."""
    path = model or default_model()

    def run(b: pa.RecordBatch):
        p = pieces(path, ALPHA)
        lists = b.column("token_ids")
        sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy().astype(np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        back, ends = decode_rows(p, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), at)
        flat, valid = back.tobytes(), lists.is_valid().to_pylist()
        yield batch(doc_id=b.column("doc_id"), decoded=pa.array([flat[ends[i] : ends[i + 1]].decode() if valid[i] else None for i in range(b.num_rows)], type=pa.string()))

    return map_batches(encoded.select("doc_id", "token_ids"), run, "doc_id long, decoded string")


def op6_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    work = Work(spark, "pieces", docs)
    out = encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return work.few(out.select("doc_id", "n_tokens", "token_ids", "lossless"))
