"""A small convolutional classifier over symbol sequences, in numpy: several filter widths, max pooling, softmax."""

import numpy as np


class ConvNet:
    """Symbols are 0 to 255, 0 being padding. Filters of all widths run as one matrix product."""

    def __init__(self, labels, widths=(2, 3, 4), filters=16, size=8, seed=11):
        rng = np.random.default_rng(seed)
        self.labels, self.most, self.size = labels, max(widths), size
        self.embed = rng.normal(0, 0.5, (256, size)).astype(np.float32)
        self.embed[0] = 0
        mask = np.concatenate([np.repeat(np.arange(self.most * size) < w * size, filters).reshape(-1, filters) for w in widths], 1)
        self.mask = mask.astype(np.float32)
        self.filters = (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32)
        self.bias = np.zeros(mask.shape[1], np.float32)
        self.out = rng.normal(0, 0.1, (mask.shape[1], labels)).astype(np.float32)
        self.prior = np.zeros(labels, np.float32)

    def _columns(self, x):
        """x holds `most - 1` symbols of padding at its end."""
        views = np.lib.stride_tricks.sliding_window_view(self.embed[x], self.most, axis=1)
        return np.ascontiguousarray(views.transpose(0, 1, 3, 2)).reshape(len(x), -1, self.most * self.size)

    def _forward(self, x):
        columns = self._columns(x)
        n, length, width = columns.shape
        maps = (columns.reshape(-1, width) @ self.filters).reshape(n, length, -1)
        at = maps.argmax(1) if self.training else None
        top = maps.max(1) + self.bias
        pooled = np.maximum(top, 0)
        scores = pooled @ self.out + self.prior
        scores -= scores.max(1, keepdims=True)
        odds = np.exp(scores)
        return columns, at, pooled, odds / odds.sum(1, keepdims=True)

    training = False

    def predict(self, x, batch=64):
        """Probabilities of the labels for rows of symbols without padding at the end."""
        x = np.pad(x, ((0, 0), (0, self.most - 1)))
        parts = [self._forward(x[i:i + batch])[3] for i in range(0, len(x), batch)]
        return np.concatenate(parts) if parts else np.zeros((0, self.labels), np.float32)

    def fit(self, x, y, epochs=5, batch=64, rate=0.01, seed=3):
        """Adam on the cross entropy."""
        x = np.pad(x, ((0, 0), (0, self.most - 1)))
        rng = np.random.default_rng(seed)
        params = [self.embed, self.filters, self.bias, self.out, self.prior]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        self.training, step = True, 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                rows, step = order[i:i + batch], step + 1
                for p, g, (m, v) in zip(params, self._gradients(x[rows], y[rows]), moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (0.3 if epoch >= epochs * 2 // 3 else 1) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
                self.embed[0] = 0
        self.training = False
        return self

    def _gradients(self, x, y):
        columns, at, pooled, p = self._forward(x)
        n, f = pooled.shape
        error = p
        error[np.arange(n), y] -= 1
        error /= n
        hidden = (error @ self.out.T) * (pooled > 0)
        picked = columns[np.arange(n)[:, None], at]
        filters = np.einsum("nf,nfk->kf", hidden, picked) * self.mask
        back = hidden[:, :, None] * self.filters.T[None]
        embed = np.zeros_like(self.embed)
        places = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(self.most)]
        np.add.at(embed, places.reshape(-1), back.reshape(-1, self.size))
        return embed, filters, hidden.sum(0), pooled.T @ error, error.sum(0)


def windows(data, offsets, size):
    """Fixed windows over the texts of a slice: (symbols padded with 0, text of each window, its length)."""
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // size))
    owner = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + number * size
    sizes = np.minimum(size, offsets[owner + 1] - starts)
    places = starts[:, None] + np.arange(size)
    inside = np.arange(size) < sizes[:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(places, len(data))], 0).astype(np.uint8), owner, sizes
