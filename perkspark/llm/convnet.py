"""A small one-dimensional convolutional network in numpy.

Input symbols (small integers, 0: padding) are dealt into rows of ``hop``
positions; learned filters of ``WIDTH`` symbols slide over them with a stride,
each row keeps a filter's maximum.  An item is followed by padding of a filter's
width at least, so that its score depends on itself alone.  Two rows in a row make a chunk, so chunks
overlap by half and cover the whole input.  The rectified chunk maxima of an
item are combined by their mean and their maximum into one logistic unit.

A filter's response is a sum of table entries, one for each symbol under it, so
that scoring is table look-ups; entries of two neighbouring symbols are summed
beforehand.
"""

from __future__ import annotations

import numpy as np

WIDTH = 8
#: Symbols of a batch that are looked at together.
PART_BYTES = 4 << 20


class ConvNet:
    def __init__(self, symbols: int, filters: int, hop: int, stride: int, seed: int):
        rng = np.random.default_rng(seed)
        self.symbols, self.filters, self.hop, self.stride = symbols, filters, hop, stride
        self.params = {
            "table": rng.normal(0, 0.3, (WIDTH, symbols, filters)).astype(np.float32),
            "shift": np.zeros(filters, np.float32),
            "mean": rng.normal(0, 0.3, filters).astype(np.float32),
            "max": rng.normal(0, 0.3, filters).astype(np.float32),
            "bias": np.zeros(1, np.float32),
        }

    def rows(self, items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All items padded to whole rows and one filter's width of zeros, each item's number of rows, where each row starts."""
        counts = np.array([max(1, -(-len(x) // self.hop)) for x in items], np.int64)
        sizes = counts * self.hop + WIDTH
        first = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), np.uint8)
        for x, at in zip(items, first.tolist(), strict=True):
            flat[at : at + len(x)] = x
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return flat, counts, np.repeat(first, counts) + nth * self.hop

    def pair_tables(self) -> np.ndarray:
        table = self.params["table"]
        return np.stack([(table[k][:, None, :] + table[k + 1][None, :, :]).reshape(-1, self.filters) for k in range(0, WIDTH, 2)])

    def maxima(self, flat: np.ndarray, starts: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each row's greatest response of each filter (and the position that had it)."""
        tables = self.pair_tables()
        n_rows = len(starts)
        inside = np.arange(0, self.hop, self.stride)
        out = np.empty((n_rows, self.filters), np.float32)
        places = np.empty((n_rows, self.filters), np.int64) if where else None
        step = max(1, (1 << 15) // (self.hop // self.stride))
        for a in range(0, n_rows, step):
            b = min(n_rows, a + step)
            # the rows' own stretch alone, so that a long text takes no more memory than a short one
            near = flat[starts[a] : starts[b - 1] + self.hop + WIDTH].astype(np.int64)
            pairs = near[:-1] * self.symbols + near[1:]
            at = (starts[a:b, None] - starts[a] + inside).ravel()
            total = tables[0].take(pairs[at], axis=0)
            for k in range(1, WIDTH // 2):
                total += tables[k].take(pairs[at + 2 * k], axis=0)
            total = total.reshape(b - a, -1, self.filters)
            out[a:b] = total.max(axis=1)
            if where:
                places[a:b] = total.argmax(axis=1) * self.stride + starts[a:b, None]
        return out, places

    def _chunks(self, row_max: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rectified chunk maxima, the row each came from, each item's chunk count."""
        n_chunks = np.maximum(counts - 1, 1)
        first = np.cumsum(counts) - counts
        start = np.repeat(first, n_chunks) + np.arange(n_chunks.sum()) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
        second = np.minimum(start + 1, np.repeat(first + counts - 1, n_chunks))
        take = row_max[second] > row_max[start]
        source = np.where(take, second[:, None], start[:, None])
        value = np.where(take, row_max[second], row_max[start]) + self.params["shift"]
        return np.maximum(value, 0), source, n_chunks

    def _logits(self, chunks: np.ndarray, n_chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.cumsum(n_chunks) - n_chunks
        mean = np.add.reduceat(chunks, starts, axis=0) / n_chunks[:, None]
        most = np.maximum.reduceat(chunks, starts, axis=0)
        return mean @ self.params["mean"] + most @ self.params["max"] + self.params["bias"][0], mean, most

    def score(self, items: list[np.ndarray]) -> np.ndarray:
        """Probabilities of the items."""
        if not items:
            return np.zeros(0)
        flat, counts, starts = self.rows(items)
        row_max, _ = self.maxima(flat, starts)
        chunks, _, n_chunks = self._chunks(row_max, counts)
        logits, _, _ = self._logits(chunks, n_chunks)
        return 1 / (1 + np.exp(-logits.astype(np.float64)))

    def _gradients(self, items: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        flat, counts, starts = self.rows(items)
        row_max, places = self.maxima(flat, starts, where=True)
        chunks, source, n_chunks = self._chunks(row_max, counts)
        logits, mean, most = self._logits(chunks, n_chunks)
        error = (1 / (1 + np.exp(-logits)) - labels) * weights / len(items)
        owner = np.repeat(np.arange(len(items)), n_chunks)
        to_chunk = (error / n_chunks)[owner, None] * self.params["mean"] + np.where(chunks == most[owner], error[owner, None] * self.params["max"], 0)
        to_chunk *= chunks > 0
        f = np.broadcast_to(np.arange(self.filters), source.shape)
        at = places[source, f]
        table = np.empty_like(self.params["table"])
        for k in range(WIDTH):
            cell = flat[at + k].astype(np.int64) * self.filters + f
            table[k] = np.bincount(cell.ravel(), to_chunk.ravel(), self.symbols * self.filters).reshape(self.symbols, self.filters)
        return {"table": table, "shift": to_chunk.sum(axis=0), "mean": mean.T @ error, "max": most.T @ error, "bias": np.array([error.sum()])}

    def _batch_gradients(self, items: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """``_gradients`` of a batch, long items in parts of ``PART_BYTES``."""
        part = np.cumsum([len(x) for x in items]) // PART_BYTES
        edges = np.flatnonzero(np.diff(part, prepend=part[0] - 1, append=part[-1] + 1)).tolist()
        if len(edges) == 2:
            return self._gradients(items, labels, weights)
        parts = [(self._gradients(items[a:b], labels[a:b], weights[a:b]), (b - a) / len(items)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return {k: sum(g[k] * share for g, share in parts) for k in self.params}

    def fit(self, items: list[np.ndarray], labels: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 0, decay: float = 1e-4, weights: np.ndarray | None = None, done: float = 0.0, share: float = 1.0) -> ConvNet:
        """Adam on the log loss; the same data and seed give the same network.

        The rate falls to zero; a call that is a ``share`` of a longer fit, of which a part is ``done``, takes that part of the fall.
        """
        rng = np.random.default_rng(seed)
        weights = np.ones(len(items)) if weights is None else weights
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        step, steps = 0, max(1, epochs * -(-len(items) // batch))
        for _ in range(epochs):
            order = rng.permutation(len(items))
            for a in range(0, len(items), batch):
                chosen = order[a : a + batch]
                gradients = self._batch_gradients([items[i] for i in chosen], labels[chosen], weights[chosen])
                step += 1
                now = rate * (1 - done - share * step / (steps + 1))
                for k, g in gradients.items():
                    g = g + decay * self.params[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                    self.params[k] = (self.params[k] - move).astype(np.float32)
        return self
