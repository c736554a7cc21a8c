"""A small convolutional network in numpy: scores, loss and gradients of a batch of images."""

from __future__ import annotations

import numpy as np

# Mean and deviation of red, green and blue that images are standardised by.
MEAN, DEVIATION = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)


class Network:
    """Blocks of a 3 x 3 convolution, ReLU and 2 x 2 maximum, then the mean over places, a dense layer with ReLU and dropout, and a dense layer to the scores.

    weights is one vector; shapes tells how it is cut. Images are (n, height, width, 3), standardised.
    """

    def __init__(self, channels: tuple[int, ...], hidden: int, classes: int = 2, dropout: float = 0.5):
        self.channels, self.hidden, self.classes, self.dropout = tuple(channels), hidden, classes, dropout
        self.shapes: list[tuple[int, ...]] = []
        for a, b in zip((3, *channels[:-1]), channels, strict=True):
            self.shapes += [(a, 3, 3, b), (b,)]
        self.shapes += [(channels[-1], hidden), (hidden,), (hidden, classes), (classes,)]
        self.size = sum(int(np.prod(s)) for s in self.shapes)

    def start(self, seed: int) -> np.ndarray:
        """Normal weights scaled by the inputs that each adds up, zero offsets."""
        draw = np.random.default_rng(seed)
        return np.concatenate([(draw.normal(0, np.sqrt(2 / np.prod(s[:-1])), s) if len(s) > 1 else np.zeros(s)).ravel() for s in self.shapes])

    def parts(self, weights: np.ndarray) -> list[np.ndarray]:
        at = np.cumsum([0, *(int(np.prod(s)) for s in self.shapes)])
        return [weights[a:b].reshape(s) for a, b, s in zip(at[:-1], at[1:], self.shapes, strict=True)]

    def kept(self, seeds: np.ndarray) -> np.ndarray:
        """Of each image the hidden numbers that dropout keeps, scaled; they depend on its seed alone."""
        drawn = np.stack([np.random.default_rng(int(s) & 0x7FFFFFFFFFFFFFFF).random(self.hidden) for s in seeds]) if len(seeds) else np.zeros((0, self.hidden))
        return (drawn >= self.dropout) / (1 - self.dropout)

    def forward(self, weights: np.ndarray, images: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, list]:
        """The scores, and what the gradient needs."""
        *convolutions, w1, b1, w2, b2 = self.parts(weights)
        x, seen = images, []
        for w, b in zip(convolutions[::2], convolutions[1::2], strict=True):
            windows = np.lib.stride_tricks.sliding_window_view(np.pad(x, [(0, 0), (1, 1), (1, 1), (0, 0)]), (3, 3), axis=(1, 2))
            y = np.maximum(np.tensordot(windows, w, axes=([3, 4, 5], [0, 1, 2])) + b, 0)
            n, rows, columns, c = y.shape
            tiles = y[:, : rows // 2 * 2, : columns // 2 * 2].reshape(n, rows // 2, 2, columns // 2, 2, c).transpose(0, 1, 3, 5, 2, 4).reshape(n, rows // 2, columns // 2, c, 4)
            best = tiles.argmax(axis=-1)
            x = np.take_along_axis(tiles, best[..., None], axis=-1)[..., 0]
            seen.append((windows, y, best))
        mean = x.mean(axis=(1, 2))
        hidden = np.maximum(mean @ w1 + b1, 0)
        out = hidden if kept is None else hidden * kept
        return out @ w2 + b2, [seen, x.shape, mean, hidden, out, kept]

    def gradient(self, weights: np.ndarray, images: np.ndarray, labels: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, float]:
        """(gradient, loss) summed over the images: cross entropy."""
        scores, (seen, shape, mean, hidden, out, kept) = self.forward(weights, images, kept)
        *convolutions, w1, _, w2, _ = self.parts(weights)
        low = scores - scores.max(axis=1, keepdims=True)
        chance = np.exp(low) / np.exp(low).sum(axis=1, keepdims=True)
        rows = np.arange(len(labels))
        loss = float(-np.log(np.maximum(chance[rows, labels], 1e-300)).sum())
        chance[rows, labels] -= 1
        slopes = [chance.sum(axis=0), out.T @ chance]
        back = (chance @ w2.T) * (1 if kept is None else kept) * (hidden > 0)
        slopes += [back.sum(axis=0), mean.T @ back]
        d = np.broadcast_to((back @ w1.T)[:, None, None] / (shape[1] * shape[2]), shape)
        for (windows, y, best), w in zip(reversed(seen), reversed(convolutions[::2]), strict=True):
            n, rows_, columns, c = y.shape
            tiles = np.zeros((n, rows_ // 2, columns // 2, c, 4))
            np.put_along_axis(tiles, best[..., None], d[..., None], axis=-1)
            whole = np.zeros_like(y)
            whole[:, : rows_ // 2 * 2, : columns // 2 * 2] = tiles.reshape(n, rows_ // 2, columns // 2, c, 2, 2).transpose(0, 1, 4, 2, 5, 3).reshape(n, rows_ // 2 * 2, columns // 2 * 2, c)
            whole *= y > 0
            slopes += [whole.sum(axis=(0, 1, 2)), np.tensordot(windows, whole, axes=([0, 1, 2], [0, 1, 2]))]
            around = np.lib.stride_tricks.sliding_window_view(np.pad(whole, [(0, 0), (1, 1), (1, 1), (0, 0)]), (3, 3), axis=(1, 2))
            d = np.tensordot(around, w[:, ::-1, ::-1], axes=([3, 4, 5], [3, 1, 2]))
        return np.concatenate([s.ravel() for s in reversed(slopes)]), loss


def standardised(bgr: np.ndarray) -> np.ndarray:
    """(n, height, width, 3) bytes in BGR to standardised numbers in RGB."""
    return (bgr[..., ::-1] / 255.0 - np.array(MEAN)) / np.array(DEVIATION)


def varied(bgr: np.ndarray, seed: int, degrees: float = 10, jitter: float = 0.2) -> np.ndarray:
    """An image mirrored or not, turned by up to so many degrees (black comes in), its brightness and contrast changed by up to a share; all told by the seed."""
    draw = np.random.default_rng(seed & 0x7FFFFFFFFFFFFFFF)
    mirror, turn, (bright, contrast) = draw.random() < 0.5, np.deg2rad(draw.uniform(-degrees, degrees)), draw.uniform(1 - jitter, 1 + jitter, 2)
    x = bgr[:, ::-1] if mirror else bgr
    h, w = x.shape[:2]
    rows, columns = np.mgrid[:h, :w]
    r, c = rows - (h - 1) / 2, columns - (w - 1) / 2
    at_r, at_c = (np.rint(v).astype(int) for v in (r * np.cos(turn) - c * np.sin(turn) + (h - 1) / 2, r * np.sin(turn) + c * np.cos(turn) + (w - 1) / 2))
    inside = (at_r >= 0) & (at_r < h) & (at_c >= 0) & (at_c < w)
    x = np.where(inside[..., None], x[np.clip(at_r, 0, h - 1), np.clip(at_c, 0, w - 1)], 0) * bright
    gray = x @ np.array([0.114, 0.587, 0.299])
    return np.clip(np.rint((x - gray.mean()) * contrast + gray.mean()), 0, 255).astype(np.uint8)
