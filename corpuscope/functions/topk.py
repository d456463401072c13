"""Best k per question inside one task: bounded memory, exact ties."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DECIMALS = 6
_BLOCK_CELLS = 4_000_000
#: Questions, and pairs, of one product of dense vectors.
_QUESTIONS = 512
_PAIRS = 1 << 19
#: Scores kept to raise floors; with more they rise when a task's results shrink.
_TOP_CELLS = 8_000_000
#: Twice the rounding of single precision, and the greatest numbers that are squared in it.
_EPSILON = 1.2e-7
_NARROW = 1e15


class BestPerQuestion:
    """Keeps the best (score desc, id asc) rows per question over many blocks.

    ``k`` has the number of rows each question wants.
    """

    def __init__(self, k: np.ndarray, id_type: pa.DataType):
        self.k = np.maximum(k, 0)
        self.most = int(self.k.max(initial=0))
        self.floor = np.where(self.k > 0, -np.inf, np.inf)
        self.empty = pa.table(
            {
                "q": pa.array([], pa.int64()),
                "score": pa.array([], pa.float64()),
                "id": pa.array([], id_type),
            }
        )
        self.parts, self.held = [], 0
        # The best scores of each question, so that a floor rises with every block.
        self.top = None
        if len(self.k) * self.most <= _TOP_CELLS:
            self.top = np.full((len(self.k), self.most), -np.inf)

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        """``scores`` is questions x rows; -inf marks rows that do not qualify."""
        order = pc.sort_indices(ids, null_placement="at_start")
        ids, s = ids.take(order), scores[:, order.to_numpy()]
        keep = (s >= self.floor[:, None]) & (s > -np.inf)
        if s.shape[1] > self.most > 0:
            kth = np.partition(s, s.shape[1] - self.most, axis=1)[:, s.shape[1] - self.most]
            keep &= s >= kth[:, None]
        q, c = np.nonzero(keep)
        if not len(q):
            return
        q, v, c = self._first(q, s[q, c], c)
        self.hold(q, v, ids.take(pa.array(c)))

    def _first(self, q: np.ndarray, v: np.ndarray, c: np.ndarray):
        """As many of each question as it wants, by score and then by number."""
        best = np.lexsort((c, -v, q))
        q, c, v = q[best], c[best], v[best]
        first = np.searchsorted(q, q, side="left")
        chosen = np.arange(len(q)) - first < self.k[q]
        return q[chosen], v[chosen], c[chosen]

    def choose(self, q: np.ndarray, v: np.ndarray, c: np.ndarray):
        """The same, and the floors rise to what is held now."""
        q, v, c = self._first(q, v, c)
        if self.top is not None and len(q):
            asked, first = np.unique(q, return_index=True)
            new = np.full((len(asked), self.most), -np.inf)
            line = np.repeat(np.arange(len(asked)), np.diff([*first, len(q)]))
            new[line, np.arange(len(q)) - first[line]] = v
            both = -np.sort(-np.hstack([self.top[asked], new]), axis=1)[:, : self.most]
            self.top[asked] = both
            self.floor[asked] = both[np.arange(len(asked)), self.k[asked] - 1]
        return q, v, c

    def hold(self, q: np.ndarray, v: np.ndarray, ids: pa.Array) -> None:
        """Keeps pairs; what cannot be among the best is left at the next shrinking."""
        self.parts.append(pa.table({"q": q, "score": v, "id": ids}))
        self.held += len(q)
        if self.held > 4 * int(self.k.sum()) + 100_000:
            self._shrink()

    def _shrink(self) -> None:
        table = pa.concat_tables(self.parts)
        high = table["score"].to_numpy() >= self.floor[table["q"].to_numpy()]
        table = table.filter(pa.array(high))
        keys = [("q", "ascending"), ("score", "descending"), ("id", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))
        q = table["q"].to_numpy()
        rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        best = rank < self.k[q]
        table = table.filter(pa.array(best))
        q, rank = q[best], rank[best]
        last = rank == self.k[q] - 1
        self.floor[q[last]] = table["score"].to_numpy()[last]
        self.parts, self.held = [table], table.num_rows

    def result(self) -> pa.Table:
        if not self.parts:
            return self.empty
        self._shrink()
        return self.parts[0]


class DenseScorer:
    """Cosine similarity or negative Euclidean distance of dense vectors.

    A product in single precision proposes: what lies below a question's worst kept score by
    more than the product's error is left. Only proposed pairs are scored, in double precision.
    """

    def __init__(self, questions: pa.Table, metric: str, best: BestPerQuestion):
        self.metric, self.best = metric, best
        specs = np.array([spec or "" for spec in _filters(questions)], dtype=object)
        # Only vectors of one length can be compared: a group has one length and one filter.
        lengths = pc.list_value_length(questions["embedding"]).to_numpy()
        self.groups = []
        for length in np.unique(lengths[lengths > 0]):
            members = np.flatnonzero(lengths == length)
            q = _matrix(questions["embedding"].take(pa.array(members)))
            whole = np.isfinite(q).all(axis=1)
            members, q = members[whole], q[whole]
            q = _unit(q) if metric == "cosine" else q
            of_spec: dict[str, list[int]] = {}
            for at, spec in enumerate(specs[members]):
                of_spec.setdefault(spec, []).append(at)
            for spec, some in of_spec.items():
                rule = json.loads(spec) if spec else None
                self.groups.append((int(length), rule, members[some], q[some]))
        self.narrow = [self._narrow(q) for *_, q in self.groups]

    def _narrow(self, q: np.ndarray) -> np.ndarray:
        if self.metric == "l2":
            q = np.hstack([q, np.ones((len(q), 1))])
        return q.astype(np.float32 if np.abs(q).max(initial=0) < _NARROW else np.float64)

    def search(self, rows: pa.Table) -> None:
        ids = rows["row_id"].combine_chunks()
        rows = rows.take(pc.sort_indices(ids, null_placement="at_start"))
        ids = rows["row_id"].combine_chunks()
        length = pc.fill_null(pc.list_value_length(rows["embedding"]), 0).to_numpy()
        vectors, found = {}, []
        for (own, rule, members, q), narrow in zip(self.groups, self.narrow):
            if own not in vectors:
                at = np.flatnonzero(length == own)
                d = _matrix(rows["embedding"].take(pa.array(at)))
                whole = np.isfinite(d).all(axis=1)
                vectors[own] = at[whole], _unit(d[whole]) if self.metric == "cosine" else d[whole]
            at, d = vectors[own]
            if rule is not None:
                fit = _mask_for(rule, rows)[at]
                at, d = at[fit], d[fit]
            if len(d):
                found += self._group(members, q, narrow, at, d)
        if found:
            q, v, c = (np.concatenate(part) for part in zip(*found))
            self.best.hold(q, v, ids.take(pa.array(c)))

    def _group(self, members, q, narrow, at, d):
        """(questions, scores, rows) of what may be among the best."""
        side, error = self._side(d)
        height = min(len(q), _QUESTIONS)
        step = max(1, _PAIRS // height)
        for a in range(0, len(q), height):
            some = slice(a, a + height)
            asked = members[some]
            square = (q[some] ** 2).sum(axis=1) if self.metric == "l2" else np.ones(len(asked))
            slack = error(square)
            for b in range(0, len(d), step):
                near = narrow[some] @ side[b : b + step].T
                least = self._least(self.best.floor[asked], square, slack)
                maybe = _not_below(near, least)
                # Many: the block's own best set a bound as well.
                if np.count_nonzero(maybe) > 4 * self.best.most * len(asked):
                    if 0 < self.best.most < near.shape[1]:
                        cut = near.shape[1] - self.best.most
                        kth = np.partition(near, cut, axis=1)[:, cut].astype(np.float64)
                        worst = self._score(kth, square, slack)
                        least = self._least(worst, square, slack)
                        maybe &= _not_below(near, least)
                pairs = np.flatnonzero(maybe)
                if not len(pairs):
                    continue
                x, y = np.divmod(pairs, near.shape[1])
                v = self._exact(q, a + x, d, b + y)
                good = (v > -np.inf) & (v >= self.best.floor[asked[x]])
                kept = self.best.choose(asked[x[good]], v[good], at[b + y[good]])
                if len(kept[0]):
                    yield kept

    def _side(self, d: np.ndarray):
        """The rows as a factor, and the greatest error of a product with it."""
        width = d.shape[1] + 8
        if self.metric == "cosine":
            side = d
            error = lambda square: np.full(len(square), width * _EPSILON)
        else:
            own = (d**2).sum(axis=1)
            side = np.hstack([2 * d, -own[:, None]])
            error = lambda square: width * _EPSILON * (square + 2 * own.max())
        narrow = np.abs(side).max(initial=0) < _NARROW
        return side.astype(np.float32 if narrow else np.float64), error

    def _least(self, score, square, slack):
        """Products below this belong to scores below ``score``, also after rounding."""
        score = score - 2 * 10.0**-DECIMALS
        if self.metric == "cosine":
            return score - slack
        # A distance beyond the greatest double has no square: nothing is left out then.
        return np.where(np.isinf(score), score, square - np.minimum(score, 0) ** 2 - slack)

    def _score(self, near, square, slack):
        """At least this is the score of a pair with such a product."""
        if self.metric == "cosine":
            return near - slack
        return -np.sqrt(np.maximum(square - near + slack, 0))

    def _exact(self, q, x, d, y) -> np.ndarray:
        out = np.empty(len(x))
        step = max(1, _BLOCK_CELLS // (2 * q.shape[1]))
        for a in range(0, len(x), step):
            part = slice(a, a + step)
            left, right = q[x[part]], d[y[part]]
            if self.metric == "cosine":
                out[part] = np.einsum("ij,ij->i", left, right)
            else:
                left -= right
                out[part] = -np.sqrt(np.einsum("ij,ij->i", left, left))
        return np.round(out, DECIMALS) + 0.0


class TermScorer:
    """Dot product of sparse term vectors; rows without a common term do not qualify."""

    columns = ("terms", "weights")

    def __init__(self, questions: pa.Table):
        self.n = questions.num_rows
        lists = questions["terms"].combine_chunks()
        owner = pc.list_parent_indices(lists).to_numpy()
        terms = pc.list_flatten(lists)
        weights = pc.list_flatten(questions["weights"].combine_chunks()).to_numpy()
        self.vocabulary = pc.unique(terms)
        code = pc.index_in(terms, value_set=self.vocabulary).to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        self.owner, self.weights = owner[order], weights[order]
        self.begin = np.searchsorted(code[order], np.arange(len(self.vocabulary) + 1))

    def blocks(self, rows: pa.Table):
        lists = rows["terms"].combine_chunks()
        owner = pc.list_parent_indices(lists).to_numpy()
        weights = pc.list_flatten(rows["weights"].combine_chunks()).to_numpy()
        code = pc.index_in(pc.list_flatten(lists), value_set=self.vocabulary)
        known = code.is_valid().to_numpy(zero_copy_only=False)
        code = code.drop_null().to_numpy()
        owner, weights = owner[known], weights[known]
        width = self.begin[code + 1] - self.begin[code]
        # Blocks of whole rows, limited by score cells and by matching pairs.
        pairs = np.bincount(owner, weights=width, minlength=rows.num_rows)
        cost = np.cumsum(np.maximum(pairs, self.n))
        at = 0
        while at < rows.num_rows:
            limit = (cost[at - 1] if at else 0) + _BLOCK_CELLS
            end = max(at + 1, int(np.searchsorted(cost, limit, side="right")))
            lo, hi = np.searchsorted(owner, [at, end])
            w = width[lo:hi]
            offset = np.repeat(self.begin[code[lo:hi]] - np.cumsum(w) + w, w)
            position = offset + np.arange(int(w.sum()))
            cell = self.owner[position] * (end - at) + np.repeat(owner[lo:hi] - at, w)
            value = self.weights[position] * np.repeat(weights[lo:hi], w)
            s = np.bincount(cell, weights=value, minlength=self.n * (end - at))
            s = s.reshape(self.n, end - at)
            # A row that has a term of the question qualifies, however small its score.
            yield rows.slice(at, end - at), np.where(s > 0, np.round(s, DECIMALS), -np.inf)
            at = end


def _not_below(near: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Products of at least a line's bound, and those that cannot be compared with it."""
    below = near < least[:, None].astype(near.dtype)
    return np.logical_not(below, out=below)


def _filters(questions: pa.Table) -> list:
    if "filter" not in questions.column_names:
        return [None] * questions.num_rows
    return questions["filter"].to_pylist()


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    vectors = vectors.combine_chunks()
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 1)


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m**2).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _mask_for(spec, rows: pa.Table) -> np.ndarray:
    """Truth of a metadata filter per row; an absent value never matches."""
    (name, argument), = spec.items()
    if name in ("and", "or"):
        parts = [_mask_for(part, rows) for part in argument]
        return np.logical_and.reduce(parts) if name == "and" else np.logical_or.reduce(parts)
    column, value = rows[argument[0]], argument[1]
    if name == "in":
        hit = pc.and_(pc.is_in(column, pa.array(value, column.type)), pc.is_valid(column))
    else:
        test = {
            "eq": pc.equal, "ne": pc.not_equal, "lt": pc.less, "lte": pc.less_equal,
            "gt": pc.greater, "gte": pc.greater_equal,
        }[name]
        hit = test(column, pa.scalar(value, column.type))
    return pc.fill_null(hit, False).to_numpy()


def _add_terms(batches, questions: pa.Table, best: BestPerQuestion) -> None:
    scorer = TermScorer(questions)
    by_filter: dict[str, list[int]] = {}
    for i, spec in enumerate(_filters(questions)):
        if spec:
            by_filter.setdefault(spec, []).append(i)
    groups = [(json.loads(spec), np.array(members)) for spec, members in by_filter.items()]
    for rows in batches:
        for part, scores in scorer.blocks(rows):
            for spec, members in groups:
                rejected = np.flatnonzero(~_mask_for(spec, part))
                scores[np.ix_(members, rejected)] = -np.inf
            best.add(scores, part["row_id"].combine_chunks())


def score_batches(batches, questions: pa.Table, kind: str, k: int, id_type: pa.DataType):
    """Best rows per question over all batches of a task, as one table: as many as the
    question's limit says, else k."""
    wanted = pc.fill_null(questions["limit"].combine_chunks(), k).to_numpy(zero_copy_only=False)
    best = BestPerQuestion(wanted.astype(np.int64), id_type)
    batches = (b if isinstance(b, pa.Table) else pa.Table.from_batches([b]) for b in batches)
    if kind == "terms":
        _add_terms(batches, questions, best)
    else:
        scorer = DenseScorer(questions, kind, best)
        for rows in batches:
            scorer.search(rows)
    found = best.result()
    picked = found["q"].combine_chunks()
    columns = {
        "query_id": questions["query_id"].combine_chunks().take(picked),
        "row_id": found["id"].combine_chunks(),
        "score": found["score"].combine_chunks(),
        "limit": questions["limit"].combine_chunks().take(picked),
    }
    return pa.table(columns)
