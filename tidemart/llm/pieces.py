"""SentencePiece encoding by sampling distinct segmentations, and decoding.

Segmentations of a text are the paths of its lattice of pieces. Gumbel top-k: perturb the log
probability of every path with its own Gumbel noise and take the k largest, without listing paths.
A-star search does so over cells, sets of paths that share a beginning and avoid some next pieces:
the largest perturbed value in a cell is one truncated Gumbel of the cell's mass, so the cell with
the largest value holds the next path, which is drawn and splits the cell into smaller ones.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm.shared import giving_back, small_batches

CHARS_AT_ONCE = 1 << 19
MOST_EDGES = 2_000_000       # lattice edges that a Python worker remembers, 24 bytes each
SHORT = 40                   # units of up to so many characters are built together
STEP = 2.0 ** -30            # resolution of the uniform numbers
WORD_UNIT = re.compile(r" *[^\W\d_]+|[^\W\d_ ]+| *(?:(?![^\W\d_])[^ ])+| +")
SPACE_UNIT = re.compile(" +[^ ]*|[^ ]+")


class Vocabulary:
    """Pieces with weights, byte pieces for other characters.

    The vocabulary gives ranks, not probabilities: a piece of rank r weighs (r + offset) ** -power.
    A character without a piece of its own is spelt by the pieces of its UTF-8 bytes, each weighing
    as the last rank. A space stands for the mark that pieces begin with.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int],
                 offset: float = 20.0, power: float = 1.0):
        self.byte_ids = byte_ids
        self.size = max([*byte_ids, *(i for i, _ in pieces.values())]) + 1
        self.texts = {i: p.encode() for p, (i, _) in pieces.items()}
        self.bytes_of = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.longest = max(map(len, pieces), default=1)
        last = max((r for _, r in pieces.values()), default=0)
        self.byte_weight = (last + offset) ** -power
        # every beginning of a piece; weight 0: only a beginning
        self.table: dict[str, tuple[int, float]] = {}
        for text, (i, rank) in pieces.items():
            for n in range(1, len(text)):
                self.table.setdefault(text[:n], (-1, 0.0))
            self.table[text] = (i, (rank + offset) ** -power)
        bare = [p.lstrip(" ") for p in pieces]
        if any(" " in p for p in bare):
            raise ValueError("a piece has a space after another character")
        mixed = any(a.isalpha() != b.isalpha() for p in bare for a, b in zip(p, p[1:]))
        self.divides = SPACE_UNIT if mixed else WORD_UNIT    # no piece crosses two units

    @classmethod
    def load(cls, model_file: str, **how) -> "Vocabulary":
        """From a SentencePiece model; ranks are its scores with the sign turned."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces, byte_ids = {}, [0] * 256
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[text.replace("▁", " ")] = (i, max(0.0, -model.get_score(i)))
        return cls(pieces, byte_ids, **how)

    def decode(self, ids) -> str:
        """The text again: pieces and bytes put together, less the space that encoding puts first."""
        texts, single = self.texts, self.bytes_of
        data = b"".join([texts[i] if i in texts else single[i] for i in ids])
        return data[1:].decode() if data else ""


class Trie:
    """Beginnings of pieces as numbered states, for many steps at once: an open hash table of
    (state, code point) to the next state. State 0 is the empty beginning."""

    SHIFT, FACTOR = 21, np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, vocabulary: Vocabulary):
        number = {"": 0} | {text: i for i, text in enumerate(vocabulary.table, 1)}
        self.weight = np.zeros(len(number))
        self.piece = np.full(len(number), -1, np.int32)
        self.bits = max(8, int(4 * len(number)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.states = np.zeros(1 << self.bits, np.int64)
        for text, (piece, weight) in vocabulary.table.items():
            state = number[text]
            self.piece[state], self.weight[state] = piece, weight
        keys = np.array([number[t[:-1]] << self.SHIFT | ord(t[-1]) for t in vocabulary.table])
        for key, slot, state in zip(keys.tolist(), self._slots(keys).tolist(),
                                    range(1, len(number))):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (1 << self.bits) - 1
            self.keys[slot], self.states[slot] = key, state

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * self.FACTOR >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, states: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Next states, -1 where no piece goes on so."""
        keys = states << self.SHIFT | points
        slots, out = self._slots(keys), np.full(len(keys), -1, np.int64)
        at = np.arange(len(keys))
        while len(at):
            there = self.keys[slots]
            hit = there == keys[at]
            out[at[hit]] = self.states[slots[hit]]
            on = np.flatnonzero(~hit & (there >= 0))
            at, slots = at[on], (slots[on] + 1) & (1 << self.bits) - 1
        return out


class Lattices:
    """Lattices of the units of texts, each built once and remembered.

    A unit is a run of spaces with the letters after it, or a run of other characters; where no
    piece crosses two units (`divides`), the lattice of a text is the chain of its units' lattices. A
    node is a place in a unit and known by its first edge. Its edges are the pieces that start
    there, longest first, with the chance that a path drawn by probability takes them and the
    running sum of chances. The last edge of a node has sum 2. `target` is the node at the piece's
    end, or -1 at the end of the unit.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.trie = vocabulary, Trie(vocabulary)
        self.clear()

    def clear(self) -> None:
        self.first: dict[str, int] = {}
        self.count = 0
        room = MOST_EDGES       # pages are taken as they are written; `store` makes more room
        self.sums, self.chance = np.empty(room), np.empty(room)
        self.code, self.target = np.empty(room, np.int32), np.empty(room, np.int32)

    def add(self, units: list[str]) -> None:
        """Units that are new, many at once; places at the same distance from their unit's end
        are summed together. Longer units, or such with tiny weights, one by one."""
        short = [u for u in units if len(u) <= SHORT]
        lost = [u for u in units if len(u) > SHORT] if len(short) < len(units) else []
        if short:
            lengths = np.array(list(map(len, short)))
            points = np.frombuffer("".join(short).encode("utf-32-le"), np.uint32).astype(np.int64)
            ends = np.repeat(np.cumsum(lengths), lengths)
            place, length, code, weight = self.edges(points, ends)
            degree = np.bincount(place, minlength=len(points))
            behind = np.where(place + length == ends[place], len(points), place + length)
            mass = np.append(np.zeros(len(points)), 1.0)
            distance = ends - np.arange(len(points))
            by_place = np.argsort(distance.astype(np.uint16), kind="stable")
            by_edge = np.argsort(distance[place].astype(np.uint16), kind="stable")
            n_places = np.cumsum(np.bincount(distance))
            n_edges = np.append(0, np.cumsum(degree[by_place]))
            for low, high in zip(n_places, n_places[1:]):
                of = by_edge[n_edges[low]:n_edges[high]]
                mass[by_place[low:high]] = np.add.reduceat(
                    weight[of] * mass[behind[of]], n_edges[low:high] - n_edges[low])
            node = np.append(np.cumsum(degree) - degree + self.count, -1)
            fine = np.minimum.reduceat(mass[:-1], np.cumsum(lengths) - lengths) > 1e-250
            self.first.update(zip(short, node[np.cumsum(lengths) - lengths].tolist()))
            lost += [short[i] for i in np.flatnonzero(~fine)]     # `add_long` gives their nodes anew
            with np.errstate(divide="ignore", invalid="ignore"):
                chance = weight * mass[behind] / mass[place]
            self.store(code, np.nan_to_num(chance), node[behind], degree)
        for u in lost:
            self.add_long(u)

    def edges(self, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces (place, length, code, weight) in the code points; no piece passes the unit's end."""
        active, states, found = np.arange(len(points)), np.zeros(len(points), np.int64), []
        bare = np.ones(len(points), bool)
        for n in range(1, self.vocabulary.longest + 1):
            states = self.trie.step(states, points[active + n - 1])
            on = states >= 0
            active, states = active[on], states[on]
            whole = self.trie.weight[states] > 0
            place = active[whole]
            found.append((place, np.full(len(place), n), self.trie.piece[states[whole]],
                          self.trie.weight[states[whole]]))
            if n == 1:
                bare[place] = False
            on = active + n < ends[active]
            active, states = active[on], states[on]
        lone = np.flatnonzero(bare)
        size = 1 + (points[lone] > 0x7F) + (points[lone] > 0x7FF) + (points[lone] > 0xFFFF)
        found.insert(0, (lone, np.ones(len(lone), np.int64), self.vocabulary.size + points[lone],
                         self.vocabulary.byte_weight ** size))
        place, length, code, weight = map(np.concatenate, zip(*found[::-1]))
        order = np.argsort(place, kind="stable")
        return place[order], length[order], code[order], weight[order]

    def add_long(self, unit: str) -> None:
        """A unit of any length, from its end; masses are scaled as they get small, as only
        ratios within a piece's reach count."""
        n, reach = len(unit), self.vocabulary.longest
        points = np.frombuffer(unit.encode("utf-32-le"), np.uint32).astype(np.int64)
        place, length, code, weight = self.edges(points, np.full(n, n))
        degree = np.bincount(place, minlength=n)
        starts = np.append(0, np.cumsum(degree))
        mass, chance = np.append(np.zeros(n), 1.0), np.zeros(len(place))
        for i in range(n - 1, -1, -1):
            of = slice(starts[i], starts[i + 1])
            x = weight[of] * mass[i + length[of]]
            mass[i] = x.sum()
            chance[of] = x / mass[i]
            if mass[i] < 1e-150:
                mass[i:i + reach + 1] *= 1e150
        self.first[unit] = self.count
        node = np.append(starts[:-1] + self.count, -1)
        self.store(code, chance, node[place + length], degree)

    def store(self, code: np.ndarray, chance: np.ndarray, target: np.ndarray, degree: np.ndarray
              ) -> None:
        low, high = self.count, self.count + len(code)
        for name in ("sums", "chance", "code", "target"):
            array = getattr(self, name)
            if high > len(array):
                wider = np.empty(high + high // 2, array.dtype)
                wider[:low] = array[:low]
                setattr(self, name, wider)
        ends = np.cumsum(degree)
        sums = np.cumsum(chance)
        sums -= np.repeat(sums[ends - 1] - np.add.reduceat(chance, ends - degree), degree)
        sums[ends - 1] = 2.0
        self.sums[low:high], self.chance[low:high] = sums, chance
        self.code[low:high], self.target[low:high] = code, target
        self.count = high

    def starts(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The units' nodes of each text."""
        new = set().union(*texts).difference(self.first)
        if new:
            self.add(list(new))
        nodes = np.array(list(map(self.first.get, chain.from_iterable(texts))), np.int64)
        return np.split(nodes, np.cumsum([len(t) for t in texts])[:-1])


def mixed_bits(seeds: np.ndarray, *places: np.ndarray | int) -> np.ndarray:
    """Random bits by seed and place: the same whatever else is drawn with them."""
    x = seeds.astype(np.uint64)
    for p in places:
        x = x + np.asarray(p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return x


def noise(seeds: np.ndarray, *places: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) by seed and place."""
    return ((mixed_bits(seeds, *places) >> np.uint64(34)).astype(np.float64) + 0.5) * STEP


def gumbel(uniform: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform))


def walk(lat: Lattices, nodes: np.ndarray, seeds: np.ndarray, places: np.ndarray, draw: int
         ) -> tuple[np.ndarray, np.ndarray]:
    """Draw a path from each node to its unit's end: (which of the nodes, edge), in path order."""
    which, at = np.arange(len(nodes)), nodes
    whose, taken, step = [], [], 0
    own = mixed_bits(seeds, places * 4 + 1, draw)
    while len(at):
        u = noise(own[which], step)
        edge = at.copy()
        rest = np.flatnonzero(u >= lat.sums[edge])
        while len(rest):
            edge[rest] += 1
            rest = rest[u[rest] >= lat.sums[edge[rest]]]
        whose.append(which)
        taken.append(edge)
        to = lat.target[edge]
        on = np.flatnonzero(to >= 0)
        which, at, step = which[on], to[on].astype(np.int64), step + 1
    if not whose:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whose, taken = np.concatenate(whose), np.concatenate(taken)
    order = np.argsort(whose, kind="stable")
    return whose[order], taken[order]


class _Text:
    """A text's paths so far, and for each the values of the cells that split off along it.

    A path is (unit of each piece, edges, running log probability, value); its cells are those from
    the place on where it left an earlier path, with the edges that were shut there.
    """

    def __init__(self, seed: int, starts: np.ndarray):
        self.seed, self.starts = seed, starts
        self.paths: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]] = []
        self.cells: list[tuple[int, np.ndarray]] = []
        self.shut: list[tuple[int, ...]] = []

    def best(self) -> tuple[float, int, int]:
        """The largest value, its path and its place on it; ties go to the earlier path."""
        value, path, place = -math.inf, 0, 0
        for i, (t, cells) in enumerate(self.cells):
            if len(cells):
                at = int(cells.argmax())
                if cells[at] > value:
                    value, path, place = float(cells[at]), i, t + at
        return value, path, place


def sample(lat: Lattices, texts: list[str], seeds: list[int], k: int
           ) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """Up to k distinct segmentations of each text: (piece codes, log probability, perturbed value,
    inclusion score), by falling perturbed value."""
    divide = lat.vocabulary.divides.findall
    nodes = lat.starts([divide(" " + t) if t else [] for t in texts])
    works = [_Text(seed, at) for seed, at in zip(seeds, nodes)]
    firsts = gumbel(noise(np.array(seeds, np.uint64), 2)).tolist() if seeds else []
    _extend(lat, [(w, None, value, 0, ()) for w, value in zip(works, firsts)], 0)
    for draw in range(1, k):
        todo = []
        chances = noise(np.array(seeds, np.uint64), 3, draw).tolist() if seeds else []
        for w, u in zip(works, chances):
            value, path, t = w.best()
            if value == -math.inf:
                continue
            edges, (from_t, cells) = w.paths[path][1], w.cells[path]
            cells[t - from_t] = -math.inf
            shut = (*(w.shut[path] if t == from_t else ()), int(edges[t]))
            edge = _other(lat, int(edges[t]), shut, u)
            todo.append((w, (path, edge), value, t, shut))
        _extend(lat, todo, draw)
    out = []
    for w in works:
        threshold = w.best()[0]
        rows = []
        for _, edges, so_far, value in w.paths:
            log_prob = float(so_far[-1]) if len(so_far) else 0.0
            with np.errstate(over="ignore"):
                inclusion = 1.0 if threshold == -math.inf else float(
                    -np.expm1(-np.exp(log_prob - threshold)))
            rows.append((lat.code[edges], log_prob, value, inclusion))
        out.append(rows)
    return out


def _other(lat: Lattices, edge: int, shut: tuple[int, ...], u: float) -> int:
    """An edge of the same node that is not shut, by chance."""
    low, high = edge, edge
    while low and lat.sums[low - 1] < 2:
        low -= 1
    while lat.sums[high] < 2:
        high += 1
    open_edges = [e for e in range(low, high + 1) if e not in shut]
    goal = u * sum(lat.chance[e] for e in open_edges)
    for e in open_edges:
        goal -= lat.chance[e]
        if goal < 0:
            return e
    return open_edges[-1]


def _extend(lat: Lattices, todo: list[tuple], draw: int) -> None:
    """Draw the path of each cell in `todo`, and the values of the cells that it splits into."""
    if not todo:
        return
    nodes, places, chosen = [], [], []
    for w, departure, _, t, _ in todo:
        if departure is None:
            at, numbers = w.starts, np.arange(len(w.starts))
        else:
            path, edge = departure
            unit, to = int(w.paths[path][0][t]), int(lat.target[edge])
            at, numbers = w.starts[unit + 1:], np.arange(unit + 1, len(w.starts))
            if to >= 0:
                at, numbers = np.concatenate([[to], at]), np.concatenate([[unit], numbers])
            chosen.append((unit, edge))
        nodes.append(at)
        places.append(numbers)
    seeds = np.array([w.seed for w, *_ in todo], np.uint64)
    counts = np.array([len(at) for at in nodes])
    numbers = np.concatenate(places).astype(np.int64)
    whose, edges = walk(lat, np.concatenate(nodes).astype(np.int64), np.repeat(seeds, counts),
                        numbers, draw)
    units = numbers[whose]
    cuts = np.searchsorted(whose, np.append(0, np.cumsum(counts)))
    if chosen:
        units = np.insert(units, cuts[:-1], [u for u, _ in chosen])
        edges = np.insert(edges, cuts[:-1], [e for _, e in chosen])
        cuts = cuts + np.arange(len(cuts))
    lengths = np.diff(cuts)
    chance = lat.chance[edges]
    logs = np.log(np.maximum(chance, 1e-300))
    before = np.array([0.0 if d is None or not t else w.paths[d[0]][2][t - 1]
                       for w, d, _, t, _ in todo])
    run = np.cumsum(logs)
    so_far = run + np.repeat(before - np.append(0.0, run)[cuts[:-1]], lengths)
    rest = 1 - chance
    for (*_, shut), at in zip(todo, cuts.tolist()):
        if shut:
            rest[at] -= sum(lat.chance[e] for e in shut)
    rest[rest < 1e-14] = 0.0            # one piece only, or nothing left but rounding
    with np.errstate(divide="ignore"):
        mass = so_far - logs + np.log(rest)
    g = gumbel(noise(np.repeat(mixed_bits(seeds, 4, draw), lengths),
                     np.arange(len(edges)) - np.repeat(cuts[:-1], lengths)))
    values = np.array([value for _, _, value, _, _ in todo])
    cells = -np.logaddexp(-np.repeat(values, lengths), -(mass + g))
    for (w, departure, value, t, shut), a, b in zip(todo, cuts.tolist(), cuts[1:].tolist()):
        path = (units[a:b], edges[a:b], so_far[a:b])
        if departure is not None:
            path = tuple(np.concatenate([old[:t], new])
                         for old, new in zip(w.paths[departure[0]], path))
        w.paths.append((*path, value))
        w.cells.append((t, cells[a:b]))
        w.shut.append(shut)


def key_seed(key: object, seed: int) -> int:
    return xxhash.xxh64_intdigest(f"{key!r}".encode(), seed)


_HELD: dict[str, tuple[Vocabulary, Lattices]] = {}


def _lattices(vocabulary: Vocabulary, name: str) -> Lattices:
    """The worker's own lattices for a vocabulary; the trie is kept between tasks."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = (vocabulary, Lattices(vocabulary))
    return _HELD[name][1]


def spelt(vocabulary: Vocabulary, codes: np.ndarray) -> np.ndarray:
    """Ids of a path: characters without a piece become the ids of their bytes."""
    if not len(codes) or codes.max() < vocabulary.size:
        return codes
    out: list[int] = []
    for c in codes.tolist():
        out.extend([c] if c < vocabulary.size else
                   [vocabulary.byte_ids[b] for b in chr(c - vocabulary.size).encode()])
    return np.array(out, np.int64)


def sampled(documents: DataFrame, model_file: str, k: int = 2, text: str = "text",
            key: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), seed: int = 13,
            offset: float = 20.0, power: float = 1.0) -> DataFrame:
    """Rows (keep..., rank, ids, log_prob, perturbed, inclusion), up to k for each document.

    `rank` from 1 by falling `perturbed`; `log_prob` is the segmentation's log probability among all
    of the text; `inclusion` the chance of a perturbed value above the (k+1)th. A text with fewer
    segmentations gives them all, with inclusion 1. A null or empty text gives one row without ids.
    Draws depend on the text, the key and the seed alone; rows with equal keys and texts draw alike.
    The vocabulary is read on the driver and handed to the tasks.
    """
    vocabulary = Vocabulary.load(model_file, offset=offset, power=power)
    spark = documents.sparkSession
    handed = spark.sparkContext.broadcast(vocabulary)     # bounded: the size of the vocabulary
    name = f"{model_file} {offset} {power}"
    kept = documents.select(*keep)
    rows = documents.select(*keep, documents[key].alias("__key"), documents[text].alias("__text"))
    schema = T.StructType([*kept.schema.fields, T.StructField("rank", T.IntegerType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("log_prob", T.DoubleType()),
                           T.StructField("perturbed", T.DoubleType()),
                           T.StructField("inclusion", T.DoubleType())])

    def some(batch: pa.RecordBatch, lat: Lattices, a: int, texts: list[str]) -> pa.RecordBatch:
        keys = batch.column("__key").slice(a, len(texts)).to_pylist()
        found = sample(lat, texts, [key_seed(x, seed) for x in keys], k)
        flat = [(i, n, spelt(lat.vocabulary, p[0]), *p[1:]) for i, paths in enumerate(found)
                for n, p in enumerate(paths)]
        places = pa.array([a + x[0] for x in flat], pa.int64())
        offsets = np.concatenate([[0], np.cumsum([len(x[2]) for x in flat])]).astype(np.int32)
        ids = np.concatenate([x[2] for x in flat]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(places) for c in keep],
             pa.array([x[1] + 1 for x in flat], pa.int32()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
             *[pa.array([x[c] for x in flat], pa.float64()) for c in (3, 4, 5)]],
            names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = _lattices(handed.value, name)
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column("__text").to_pylist()]
                begin, held = 0, 0
                for i, t in enumerate(texts):
                    held += len(t)
                    if held >= CHARS_AT_ONCE or i + 1 == len(texts):
                        yield some(batch, lat, begin, texts[begin:i + 1])
                        begin, held = i + 1, 0
                        if lat.count > MOST_EDGES:
                            lat.clear()
        finally:
            lat.clear()     # workers outlive their tasks

    return small_batches(rows).mapInArrow(giving_back(run), schema)


def decoded(encoded: DataFrame, model_file: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with the text that `ids` stand for added; null ids give null."""
    handed = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file))
    if text in encoded.columns:
        raise ValueError(f"{text} is in use")
    schema = T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else handed.value.decode(x)
                     for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=schema.names)

    return encoded.mapInArrow(run, schema)
