"""Segmentation lattices over a SentencePiece vocabulary, sampled without replacement by a Gumbel-perturbed A* search.

A text is cut wherever two neighbouring characters stand together in no piece of the vocabulary. No piece crosses such a cut, so the text's lattice is the
chain of the lattices of the units between cuts. A unit's lattice is built once for a batch and kept; all steps are vectorised over units and documents.

Search. A node of the search tree is a set of segmentations with a common beginning; its log-mass is known from the lattice's backward sums. The root
gets a Gumbel value, and children get Gumbel values under the condition that their maximum is their parent's. Going down the best child leaves its
siblings as one open node a step (their joint Gumbel value, truncated at the parent's); the next sample continues at the best open node of all. The
first k leaves are therefore k distinct segmentations in the order of a Gumbel top-k draw, and the best open node left gives the threshold of
the inclusion probabilities. Open nodes whose value can't reach the best, even with the largest value that a 53-bit uniform number yields, aren't drawn.
"""

from __future__ import annotations

import numpy as np
import sentencepiece

from tramline.llm.shingles import BASE, U, mix, powers

BLANK_MARK, OWN_MARK = 0x2581, 0x110001
#: Pieces are taken to follow a Zipf-Mandelbrot law in the order of the vocabulary's scores.
ZIPF_SHIFT = 2.7
MAX_UNITS = 250_000
MAX_EDGES = 2_000_000
#: Largest value of -log(-log(u)), with a margin.
GUMBEL_REACH = 45.0
STEP = U((BASE * 7) % (1 << 64) | 1)
#: Backward sums of units below this size are linear, with this factor (as a logarithm) a character; those of others are logarithmic.
SMALL = 48
PER_CHARACTER = 2.5


def uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """In (0, 1): a function of the row's (mixed) seed and the place in its search alone."""
    return ((mix(seed + place.astype(U) * STEP) >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Table:
    """Whole numbers by 64-bit key, each at one of two slots, so that a look-up is two gathers for a whole array of keys."""

    def __init__(self, known: dict[int, int], bits: int = 18) -> None:
        while len(known) * 3 > 1 << bits:
            bits += 1
        self.shift, self.mask = U(64 - bits), U((1 << bits) - 1)
        self.keys, self.values = np.zeros(1 << bits, U), np.zeros(1 << bits, np.int32)
        slots = lambda k: (k >> (64 - bits), (k >> (40 - bits)) & ((1 << bits) - 1))
        self.second = U(40 - bits)
        at: dict[int, int] = {}
        for key in known:
            slot = slots(key)[0]
            for _ in range(500):
                key, at[slot] = at.get(slot), key
                if key is None:
                    break
                one, two = slots(key)
                slot = two if slot == one else one
            else:
                raise ValueError("the vocabulary's pieces can't be placed")
        for slot, key in at.items():
            self.keys[slot], self.values[slot] = key, known[key]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``keys`` of those that are known, in order, and their values."""
        slot = (keys >> self.shift).astype(np.int64)
        hit = self.keys[slot] == keys
        lack = np.flatnonzero(~hit)
        slot[lack] = other = ((keys[lack] >> self.second) & self.mask).astype(np.int64)
        hit[lack] = self.keys[other] == keys[lack]
        alive = np.flatnonzero(hit)
        return alive, self.values[slot[alive]]


class Vocabulary:
    def __init__(self, model: bytes) -> None:
        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = p.get_piece_size()
        self.pieces = [p.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        self.byte_id = {int(self.pieces[i][1:-1], 16): i for i in range(n) if p.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary needs byte pieces")
        self.bytes_of = [b""] * n
        for i in plain:
            self.bytes_of[i] = self.pieces[i].replace("▁", " ").encode()
        for b, i in self.byte_id.items():
            self.bytes_of[i] = bytes([b])
        self.spelling = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.n_bytes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.spelled_at = np.cumsum(self.n_bytes) - self.n_bytes
        order = sorted(plain, key=lambda i: (-p.get_score(i), i))
        log_p = -np.log(np.arange(len(order)) + ZIPF_SHIFT)
        self.log_p = np.zeros(n)
        self.log_p[order] = log_p - np.log(np.exp(log_p).sum())
        self.byte_log_p = float(self.log_p[order].min()) - 2.0  # of one byte piece
        prefixes: dict[int, int] = {}  # hash of a piece's beginning -> its piece, or -1
        pairs = set()
        self.longest = max(len(self.pieces[i]) for i in plain)
        for i in plain:
            h = 0
            for c in self.pieces[i]:
                h = ((h + ord(c) + 1) * BASE) % (1 << 64)
                prefixes.setdefault(h, -1)
            prefixes[h] = i
            pairs.update(zip(self.pieces[i], self.pieces[i][1:], strict=False))
        self.prefixes = Table(prefixes)
        self.single = np.zeros(OWN_MARK + 1, bool)
        self.single[[ord(self.pieces[i]) for i in plain if len(self.pieces[i]) == 1]] = True
        kinds = {c: k for k, c in enumerate(sorted({c for pair in pairs for c in pair}), 1)}
        self.kind = np.zeros(OWN_MARK + 1, np.int16 if len(kinds) < 1 << 15 else np.int32)
        for c, k in kinds.items():
            self.kind[ord(c)] = k
        self.joined = np.zeros((len(kinds) + 1, len(kinds) + 1), bool)
        for a, b in pairs:
            self.joined[kinds[a], kinds[b]] = True

    def bytes_ids(self, code: int) -> list[int]:
        return [self.byte_id[b] for b in chr(BLANK_MARK if code == OWN_MARK else code).encode("utf-8", "replace")]

    def decode(self, ids: list[int]) -> str:
        """The text again; the blank that encoding puts in front is taken away."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def bytes_of_all(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a run of pieces."""
        n = self.n_bytes[ids]
        ends = np.cumsum(n)
        return self.spelling[np.repeat(self.spelled_at[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class Growing:
    """An array with room to grow, so that adding to it again and again stays linear."""

    def __init__(self, dtype: type, *start: int) -> None:
        self.n, self.data = len(start), np.array([*start, 0], dtype)[: max(1, len(start))]

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            wider = np.empty(self.n + max(self.n, len(more)) * 5 // 4, self.data.dtype)  # the room takes no memory before it is used
            wider[: self.n] = self.data[: self.n]
            self.data = wider
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)


class Lattices:
    """Lattices of all units seen so far. A node is a place in a unit; its edges lie together, longest piece first."""

    SLOTS = 20

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.ascii = np.array([vocabulary.byte_id[i] for i in range(128)], np.int32)
        self.clear()

    def clear(self) -> None:
        self.ids: dict[int, int] = {}  # of each unit, by its hash
        self._slot_key, self._slot_id = np.zeros(1 << self.SLOTS, U), np.zeros(1 << self.SLOTS, np.int32)  # the units met last, for look-ups of whole arrays
        self._root = Growing(np.int32)  # of each unit: its first node
        self._first = Growing(np.int32, 0)  # of each node: its first edge
        self._upto = Growing(np.float32)  # of each edge: probability of this edge and those before it
        self._log_p, self._log_rest = Growing(np.float32), Growing(np.float32)
        self._next = Growing(np.int32)  # node, or -1 at the unit's end
        self._code = Growing(np.int32)  # piece, or -1 less a character that is spelled in bytes

    root, first, upto, log_p, log_rest, next, code = (property(lambda self, k=k: getattr(self, k).data[: getattr(self, k).n]) for k in ("_root", "_first", "_upto", "_log_p", "_log_rest", "_next", "_code"))

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units of all texts, one after the other, and each text's bounds in them. New units get their lattices.

        Units are told apart by 64-bit hashes. A collision would spell another text, which the caller sees when it decodes.
        """
        codes = np.frombuffer("".join([f" {t}" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        blank, own = codes == 0x20, codes == BLANK_MARK
        codes[blank], codes[own] = BLANK_MARK, OWN_MARK
        ends = np.cumsum([len(t) + 1 for t in texts])
        kind = self.v.kind[codes]
        cut = np.ones(len(codes), bool)
        np.logical_not(self.v.joined[kind[:-1], kind[1:]], out=cut[1:])
        cut[ends[:-1]] = True
        begins = np.flatnonzero(cut)
        size = np.diff(begins, append=len(codes))
        up, down = powers(len(codes))
        sums = np.zeros(len(codes) + 1, U)
        np.cumsum((codes + 1).astype(U) * up, out=sums[1:])
        keys = mix((sums[begins + size] - sums[begins]) * down[begins] + size.astype(U))
        slot = (keys >> U(64 - self.SLOTS)).astype(np.int64)
        found = self._slot_id[slot]
        lack = np.flatnonzero(self._slot_key[slot] != keys)
        if len(lack):
            met, at, back = np.unique(keys[lack], return_index=True, return_inverse=True)
            known = np.fromiter(map(self.ids.__contains__, met.tolist()), bool, len(met))
            fresh = lack[at[~known]]
            for linear, part in self._by_size(codes, begins[fresh], size[fresh]):
                self.ids.update(zip(keys[fresh[part]].tolist(), range(len(self.ids), len(self.ids) + len(part)), strict=True))
                n = size[fresh[part]]
                self._build(codes[np.repeat(begins[fresh[part]] - np.cumsum(n) + n, n) + np.arange(n.sum())], n, linear)
            found[lack] = np.fromiter(map(self.ids.__getitem__, met.tolist()), np.int32, len(met))[back]
            self._slot_key[slot[lack]], self._slot_id[slot[lack]] = keys[lack], found[lack]
        return found, np.concatenate([[0], np.searchsorted(begins, ends)])

    def _by_size(self, codes: np.ndarray, begins: np.ndarray, size: np.ndarray) -> list[tuple[bool, np.ndarray]]:
        """Units whose sums stay far from the smallest numbers, and others (long, or with characters that are spelled in bytes)."""
        if not len(begins):
            return []
        odd = np.concatenate([[0], np.cumsum(~self.v.single[codes])])
        small = (size < SMALL) & ((odd[begins + size] == odd[begins]) | (size < 5))
        return [(linear, x) for linear, x in ((True, np.flatnonzero(small)), (False, np.flatnonzero(~small))) if len(x)]

    def _build(self, codes: np.ndarray, size: np.ndarray, linear: bool) -> None:
        """Lattices of new units."""
        n, v = len(codes), self.v
        end = np.repeat(np.cumsum(size), size)  # of each place: its unit's end
        left = end - np.arange(n)
        places, pieces = [], []
        at, h = np.arange(n), np.zeros(n, U)
        count = np.zeros(n, np.int64)
        for k in range(v.longest):
            h = (h + codes[at + k].astype(U) + U(1)) * U(BASE)
            alive, piece = v.prefixes.find(h)
            at, h = at[alive], h[alive]
            whole = piece >= 0
            places.append(at[whole])
            pieces.append(piece[whole])
            count[places[-1]] += 1
            more = left[at] > k + 1
            at, h = at[more], h[more]
            if not len(at):
                break
        spelled = np.ones(n, bool)
        spelled[places[0]] = False
        spelled = np.flatnonzero(spelled)
        count[spelled] += 1
        first = np.concatenate([[0], np.cumsum(count)])
        free = first[:-1].copy()
        total = int(first[-1])
        code, length = np.empty(total, np.int32), np.ones(total, np.int8 if v.longest < 128 else np.int32)
        for k in range(len(places) - 1, -1, -1):
            where = free[places[k]]
            code[where], length[where] = pieces[k], k + 1
            free[places[k]] += 1
        c = codes[spelled]
        where = free[spelled]
        code[where] = -c - 1
        score = v.log_p[np.maximum(code, 0)]
        score[where] = np.where(c == OWN_MARK, 3, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)) * v.byte_log_p
        start = np.repeat(np.arange(n), count)
        goal = start + length
        inner = length < left[start]
        # backward sums, by the distance of the place from its unit's end
        by = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        n_by = count[by]
        order = np.repeat(first[by] - np.cumsum(n_by) + n_by, n_by) + np.arange(total)
        target = np.where(inner, goal, n)[order]
        rounds = np.flatnonzero(np.diff(left[by], prepend=0))
        bounds = np.concatenate([[0], np.cumsum(n_by)])
        if linear:
            p = self._linear(score, length, order, target, by, rounds, bounds, start)
        else:
            p = self._logarithmic(score, order, target, by, rounds, bounds, start)
        # whole numbers add up alike whatever else is in the batch
        sums = np.concatenate([[0], np.cumsum(np.rint(p * 2.0**40).astype(np.int64))])
        upto = ((sums[1:] - sums[first[start]]) * 2.0**-40).astype(np.float32)
        upto[first[1:] - 1] = 2.0  # a place's last edge takes what rounding leaves
        with np.errstate(divide="ignore"):
            log_p, rest = np.log(p), np.log1p(-p)
        rest[(count == 1)[start]] = -np.inf
        nodes, edges = self._first.n - 1, self._code.n
        self._root.add(nodes + np.cumsum(size) - size)
        self._first.add(edges + first[1:])
        self._upto.add(upto)
        self._log_p.add(np.maximum(log_p, -1e30))
        self._log_rest.add(np.where(np.isneginf(rest) & (count > 1)[start], np.log(1e-300), rest))
        self._next.add(np.where(inner, nodes + goal, -1))
        self._code.add(code)

    @staticmethod
    def _linear(score, length, order, target, by, rounds, bounds, start) -> np.ndarray:
        """Probabilities of the edges of each place."""
        weight = np.exp(score + PER_CHARACTER * length)[order]
        mass = np.ones(len(by) + 1)
        for a, b in zip(rounds, np.append(rounds[1:], len(by)), strict=True):
            lo, hi = bounds[a], bounds[b]
            weight[lo:hi] *= mass[target[lo:hi]]
            mass[by[a:b]] = np.add.reduceat(weight[lo:hi], bounds[a:b] - lo)
        p = np.empty(len(weight))
        p[order] = weight
        return np.minimum(p / mass[start], 1.0)

    @staticmethod
    def _logarithmic(score, order, target, by, rounds, bounds, start) -> np.ndarray:
        weight = score[order]
        mass = np.zeros(len(by) + 1)
        for a, b in zip(rounds, np.append(rounds[1:], len(by)), strict=True):
            lo, hi = bounds[a], bounds[b]
            w = weight[lo:hi] = weight[lo:hi] + mass[target[lo:hi]]
            at = bounds[a:b] - lo
            top = np.maximum.reduceat(w, at)
            mass[by[a:b]] = top + np.log(np.add.reduceat(np.exp(w - np.repeat(top, np.diff(np.append(at, hi - lo)))), at))
        log_p = np.empty(len(weight))
        log_p[order] = weight
        return np.exp(np.minimum(log_p - mass[start], 0.0))

    def walk(self, nodes: np.ndarray, seed: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draws a path from each of the nodes to its unit's end: all edges in order, and how many each path has."""
        who, found = np.arange(len(nodes)), []
        count = np.zeros(len(nodes), np.int64)
        first, upto, following = self.first, self.upto, self.next
        step = 0
        while len(who):
            edge = first[nodes].astype(np.int64)
            open_ = np.flatnonzero(upto[edge] < 2)  # elsewhere there is one way only
            u = uniform(seed[who[open_]], place[who[open_]] + step).astype(np.float32)
            again = np.flatnonzero(u >= upto[edge[open_]])
            while len(again):
                edge[open_[again]] += 1
                again = again[u[again] >= upto[edge[open_[again]]]]
            found.append((who, edge))
            count[who] += 1
            nodes = following[edge]
            go = nodes >= 0
            who, nodes = who[go], nodes[go]
            step += 1
        begin = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int64)
        for k, (who, edge) in enumerate(found):
            out[begin[who] + k] = edge
        return out, count


def log_inclusion(x: float) -> float:
    """ln(1 - exp(-exp(x))): the log-probability of a Gumbel value above the threshold; stable where it is far too small for a float."""
    return x if x < -30 else 0.0 if x > 5 else float(np.log(-np.expm1(-np.exp(x))))


def sample(lattices: Lattices, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k distinct segmentations: (ids, log-probability, perturbed value, log of the inclusion probability), best value first."""
    if len(lattices.ids) > MAX_UNITS or len(lattices.code) > MAX_EDGES:
        lattices.clear()
    units, cuts = lattices.units(texts)
    L, n = lattices, len(texts)
    root = L.root
    value = -np.log(-np.log(uniform(seeds, np.full(n, 1 << 60))))  # the root's Gumbel value
    results: list[list] = [[] for _ in range(n)]
    #: of each text: open nodes (value, the sample they branch from, step, edges already taken)
    open_: list[list] = [[] for _ in range(n)]
    first, log_p_of, code_of = L.first, L.log_p, L.code
    todo = [(d, np.zeros(0, np.int64), 0, -1) for d in range(n)]  # text, edges so far, next unit, node inside the unit before it
    for r in range(k):
        if not todo:
            break
        nodes, place = [], []
        for d, _, unit, inside in todo:
            own = root[units[cuts[d] + unit + (inside >= 0) : cuts[d + 1]]]
            if inside >= 0:
                own = np.concatenate([[inside], own])
            nodes.append(own)
            place.append(np.arange((unit << 24) + (r << 54), ((unit + len(own)) << 24) + (r << 54), 1 << 24, dtype=np.int64))
        sizes = [len(x) for x in nodes]
        edges, count = L.walk(np.concatenate(nodes), np.repeat(seeds[[t[0] for t in todo]], sizes), np.concatenate(place))
        cut = np.concatenate([[0], np.cumsum(sizes)])
        steps = np.concatenate([[0], np.cumsum(count)])[cut]
        paths = []
        for j, (d, so_far, _, _) in enumerate(todo):
            paths.append(np.concatenate([so_far, edges[steps[j] : steps[j + 1]]]))
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
        every = np.concatenate(paths)
        log_p = log_p_of[every].astype(np.float64)
        log_rest = L.log_rest[every]
        for j, (d, so_far, _, _) in enumerate(todo):
            a, b = bounds[j], bounds[j + 1]
            sums = np.cumsum(log_p[a:b])
            results[d].append([every[a:b], float(sums[-1]), float(value[d])])
            own = (sums - log_p[a:b] + log_rest[a:b])[len(so_far) :]
            if len(own) and np.isfinite(top := own.max()):
                near = np.flatnonzero(own >= top - GUMBEL_REACH)
                e = -np.log(uniform(np.full(len(near), seeds[d], U), near + len(so_far) + ((r + 1) << 40) + (1 << 61)))
                with np.errstate(over="ignore"):
                    v = -np.log(np.exp(-value[d]) + np.exp(-own[near]) * e)
                keep = np.argsort(-v, kind="stable")[: k - r]  # no more than these can be continued or be the threshold
                open_[d] += [(float(v[i]), r, int(near[i]) + len(so_far), ()) for i in keep]
        if r + 1 == k:
            break
        todo = []
        for d in range(n):
            if not open_[d]:
                continue
            best = max(range(len(open_[d])), key=lambda i: open_[d][i])
            v, parent, s, out = open_[d].pop(best)
            path = results[d][parent][0]
            out = (*out, int(path[s])) if not out else out
            node = int(first.searchsorted(first.dtype.type(path[s]), side="right")) - 1  # of the same type, or all of it would be converted
            choice = [e for e in range(first[node], first[node + 1]) if e not in out]
            p = np.exp(log_p_of[choice].astype(np.float64))
            u = uniform(seeds[d : d + 1], np.array([(r + 1) * (1 << 20) + (1 << 62)]))
            edge = choice[min(int(np.searchsorted(np.cumsum(p), u[0] * p.sum(), side="right")), len(choice) - 1)]
            left = float(p.sum() - np.exp(float(log_p_of[edge])))
            if len(choice) > 1 and left > 0:
                base = float(log_p_of[path[:s]].astype(np.float64).sum()) + np.log(left)
                e = -np.log(uniform(seeds[d : d + 1], np.array([(r + 1) * (1 << 20) + (1 << 62) + 1])))[0]
                with np.errstate(over="ignore"):
                    open_[d].append((float(-np.log(np.exp(-v) + np.exp(-base) * e)), parent, s, (*out, edge)))
            value[d] = v
            so_far = np.append(path[:s], edge)
            unit = int((L.next[so_far] < 0).sum())
            todo.append((d, so_far, unit, int(L.next[edge])))
    final = []
    for d in range(n):
        top = max((x[0] for x in open_[d]), default=-np.inf)
        rows = []
        for path, log_p, v in results[d]:
            inclusion = 0.0 if len(results[d]) < k or top == -np.inf else log_inclusion(log_p - top)
            rows.append((_spell(L, code_of[path]), log_p, v, inclusion))
        final.append(rows)
    return final


def _spell(L: Lattices, code: np.ndarray) -> np.ndarray:
    """Ids of edges; characters without a piece become their bytes."""
    odd = np.flatnonzero(code < 0)
    if not len(odd):
        return code
    low = odd[code[odd] >= -128]
    code[low] = L.ascii[-code[low] - 1]
    odd = odd[code[odd] < 0]
    if not len(odd):
        return code
    spelled = [L.v.bytes_ids(-int(c) - 1) for c in code[odd]]
    times = np.ones(len(code), np.int64)
    times[odd] = [len(x) for x in spelled]
    out = np.repeat(code, times)
    out[out < 0] = np.concatenate(spelled)
    return out.astype(np.int32)
