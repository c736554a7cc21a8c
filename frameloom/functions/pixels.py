"""Pixel kernels over numpy arrays, called on Arrow batches. Formulas follow the public colour and filter definitions in 8 bits."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def gray(bgr: np.ndarray) -> np.ndarray:
    return ((bgr.astype(np.int32) @ np.array([114, 587, 299], np.int32) + 500) // 1000).astype(np.uint8)


def _descaled(x: np.ndarray, bits: int) -> np.ndarray:
    """x / 2 ** bits, rounded half up."""
    return (x + (1 << (bits - 1))) >> bits


# 12 bits of fraction for quotients of colours; for L, a, b also 3 bits more than 8 for linear light and 15 for cube roots, the matrix and white of sRGB under D65.
_HSV_BITS, _LAB_BITS, _GAMMA_BITS, _ROOT_BITS = 12, 12, 3, 15
_TO_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
_WHITE = np.array([0.950456, 1.0, 1.088754])


def _quotients(whole: int) -> np.ndarray:
    """whole / i with _HSV_BITS bits of fraction, for i of 8 bits; 0 for 0."""
    return np.append(0, np.rint((whole << _HSV_BITS) / np.arange(1.0, 256))).astype(np.int64)


_SHARES, _SIXTHS = _quotients(255), np.append(0, np.rint((180 << _HSV_BITS) / (6 * np.arange(1.0, 256)))).astype(np.int64)


def hsv(bgr: np.ndarray) -> np.ndarray:
    """Hue (0 ... 179), saturation and value (0 ... 255) in fixed point: quotients come from tables."""
    b, g, r = (bgr[..., k].astype(np.int64) for k in range(3))
    value, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    gap = value - low
    turn = np.where(value == r, g - b, np.where(value == g, b - r + 2 * gap, r - g + 4 * gap))
    hue = _descaled(turn * _SIXTHS[gap], _HSV_BITS)
    return np.stack([np.where(hue < 0, hue + 180, hue), _descaled(gap * _SHARES[value], _HSV_BITS), value], axis=-1).astype(np.uint8)


def saturation_value(bgr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = hsv(bgr).astype(float)
    return found[..., 1], found[..., 2]


def _light_table() -> np.ndarray:
    """Linear light of each byte, 8 + _GAMMA_BITS bits."""
    x = np.arange(256) / 255
    return np.rint(255 * (1 << _GAMMA_BITS) * np.where(x <= 0.04045, x / 12.92, ((x + 0.055) / 1.055) ** 2.4)).astype(np.int64)


def _root_table() -> np.ndarray:
    """The cube root of each linear light, straight near zero, with _ROOT_BITS bits of fraction."""
    x = np.arange(256 * 3 // 2 << _GAMMA_BITS) / (255 * (1 << _GAMMA_BITS))
    return np.rint((1 << _ROOT_BITS) * np.where(x < 0.008856, x * 7.787 + 16 / 116, np.cbrt(x))).astype(np.int64)


_LIGHT, _ROOT = _light_table(), _root_table()
_XYZ = np.rint(_TO_XYZ / _WHITE[:, None] * (1 << _LAB_BITS)).astype(np.int64)


def lab(bgr: np.ndarray) -> np.ndarray:
    """L scaled to 0 ... 255, a and b shifted by 128, from sRGB under D65, in fixed point: light and roots come from tables."""
    x, y, z = np.moveaxis(_ROOT[_descaled(_LIGHT[bgr[..., ::-1]] @ _XYZ.T, _LAB_BITS)], -1, 0)
    scale, shift = (116 * 255 + 50) // 100, (16 * 255 * (1 << _ROOT_BITS) + 50) // 100
    parts = [scale * y - shift, 500 * (x - y) + (128 << _ROOT_BITS), 200 * (y - z) + (128 << _ROOT_BITS)]
    return np.clip(np.stack([_descaled(p, _ROOT_BITS) for p in parts], axis=-1), 0, 255).astype(float)


def filtered(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Correlation with a small odd kernel, the image mirrored at its edges without repeating them."""
    pad = kernel.shape[0] // 2
    wide = np.pad(x.astype(float), [(min(pad, n - 1),) * 2 if n > 1 else (0, 0) for n in x.shape], "reflect")
    wide = np.pad(wide, [(max(0, (n + 2 * pad - m)) // 2,) * 2 for n, m in zip(x.shape, wide.shape, strict=True)], "edge")
    return np.einsum("ijkl,kl->ij", np.lib.stride_tricks.sliding_window_view(wide, kernel.shape), kernel)


BLUR = np.outer([0.25, 0.5, 0.25], [0.25, 0.5, 0.25])
LAPLACE = np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], float)
_SIDE = np.exp(-(np.arange(-1, 2) ** 2) / (2 * 1.5**2))
GAUSS = np.outer(_SIDE, _SIDE) / _SIDE.sum() ** 2


def otsu_cut(x: np.ndarray) -> int:
    """The level that parts the histogram best; the first of equals."""
    n = np.bincount(x.ravel(), minlength=256).astype(float)
    below, mass = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = n.sum() - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return int(np.nan_to_num(between).argmax())


def component_sizes(mask: np.ndarray) -> np.ndarray:
    """Sizes of the 8-connected parts of a mask, in order of their first pixels.

    Rows are cut into runs; runs of neighbouring rows that touch, corners included, are found by their ends' places, and joined by union-find.
    """
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]  # of the same run, as both come row by row
    wide = mask.shape[1] + 2
    first = np.searchsorted(row * wide + end, (row + 1) * wide + start, "left")
    stop = np.searchsorted(row * wide + start, (row + 1) * wide + end, "right")
    touching = np.maximum(stop - first, 0)
    above = np.repeat(np.arange(len(row)), touching)
    below = np.arange(touching.sum()) - np.repeat(np.cumsum(touching) - touching, touching) + np.repeat(first, touching)
    root = list(range(len(row)))

    def found(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for a, b in zip(above.tolist(), below.tolist(), strict=True):
        x, y = found(a), found(b)
        root[max(x, y)] = min(x, y)
    return np.bincount([found(k) for k in range(len(row))], end - start, len(row))[[k for k in range(len(row)) if root[k] == k]].astype(np.int64) if len(row) else np.empty(0, np.int64)


def longest_run(flags: np.ndarray) -> tuple[int, int]:
    """[start, end) of the longest run of true, the first of equals; (0, 0) if there is none."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(int), [0]])))
    if not len(edge):
        return 0, 0
    start, end = edge[::2], edge[1::2]
    k = int(np.argmax(end - start))
    return int(start[k]), int(end[k])


def dark_features(bgr: np.ndarray) -> dict[str, float]:
    g = gray(bgr)
    parts, level = component_sizes(g <= 50), np.bincount(g.ravel(), minlength=256)
    return {
        "gray_mean": 1 - g.mean() / 255, "dark_ratio": level[:50].sum() / g.size, "hist_centroid": 1 - (level @ np.arange(256)) / g.size / 255,
        "hsv_v": 1 - saturation_value(bgr)[1].mean() / 255, "lab_l": 1 - lab(bgr)[..., 0].mean() / 255, "very_dark_ratio": level[:30].sum() / g.size,
        "dark_concentration": min(parts.mean() / (0.5 * g.size), 1.0) if len(parts) else 0.0, "max_dark_region": parts.max() / g.size if len(parts) else 0.0,
    }


def line_features(bgr: np.ndarray) -> dict[str, float]:
    """Of one region: how much one dark band holds, how unbroken, strong and alone it is."""
    if bgr.shape[0] > bgr.shape[1]:
        bgr = np.rot90(bgr, -1)
    g = np.floor(filtered(gray(bgr), BLUR) + 0.5).astype(np.uint8)
    dark = g <= otsu_cut(g)
    rows = dark.mean(axis=1)
    start, end = longest_run(rows > rows.max() * 0.3)
    start, end = (start, end) if end else (0, 1)
    outside, some = np.concatenate([rows[:start], rows[end:]]), np.flatnonzero(rows > 0.05)
    across = longest_run(dark[min((start + end) // 2, len(rows) - 1)])
    return {
        "concentration": rows[start:end].sum() / rows.sum() if rows.sum() > 0.01 else 0.0, "h_cont": (across[1] - across[0]) / dark.shape[1], "peak": rows.max(),
        "outside_max": outside.max() if len(outside) else 0.0, "first": int(some[0]) if len(some) else 0, "last": int(some[-1]) if len(some) else 0, "rows": len(some), "band_ratio": (end - start) / len(rows),
    }


def pair_features(a: np.ndarray, b: np.ndarray) -> dict[str, float]:
    """Of two gray images: share of like pixels after a blur, their mean difference, and local likeness (SSIM)."""
    gap = np.abs(np.floor(filtered(a, BLUR) + 0.5) - np.floor(filtered(b, BLUR) + 0.5))
    x, y, c1, c2 = a.astype(float), b.astype(float), 6.5025, 58.5225
    inner = (slice(1, -1),) * 2 if min(a.shape) > 2 else (slice(None),) * 2
    mx, my, xx, yy, xy = (filtered(z, GAUSS)[inner] for z in (x, y, x * x, y * y, x * y))
    vx, vy, cov = np.maximum(xx - mx * mx, 0), np.maximum(yy - my * my, 0), xy - mx * my
    both = np.sqrt(vx * vy)
    level, contrast, structure = (2 * mx * my + c1) / (mx**2 + my**2 + c1), (2 * both + c2) / (vx + vy + c2), (cov + c2 / 2) / (both + c2 / 2)
    return {
        "psim": 1 - (gap > 25).mean(), "absdiff": gap.mean() / 255, "ssim": (level * contrast * structure).mean(), "l": level.mean(), "c": contrast.mean(), "s": structure.mean(),
        "mu": np.abs(mx - my).mean() / 255, "sigma": np.abs(vx - vy).mean(),
    }


def colour_features(bgr: np.ndarray) -> dict[str, float | None]:
    """Of one region's foreground: mean and deviation of a and b, and its mean colour (null where there is none)."""
    s, v = saturation_value(bgr)
    mask = (s > 20) | (v < 245)
    if not mask.any():
        return dict.fromkeys(("mean_a", "mean_b", "std_a", "std_b"), 0.0) | dict.fromkeys(("blue", "green", "red"))
    ab, bgr = lab(bgr)[mask][:, 1:], bgr[mask].mean(axis=0)
    return dict(zip(("mean_a", "mean_b", "std_a", "std_b", "blue", "green", "red"), (*ab.mean(axis=0), *ab.std(axis=0), *bgr), strict=True))


def quality_features(bgr: np.ndarray) -> dict[str, float]:
    g = gray(bgr)
    p = np.bincount(g.ravel(), minlength=256) / g.size
    return {"blur": filtered(g, LAPLACE).var(), "bright": g.mean(), "contrast": g.std(), "entropy": -(p[p > 0] * np.log2(p[p > 0])).sum(), "dark": (g < 30).mean(), "over": (g > 225).mean()}


def beside(images: list[np.ndarray], ground: int = 255) -> np.ndarray:
    """Images in a row, top-aligned on a ground as high as the highest."""
    out = np.full((max(i.shape[0] for i in images), sum(i.shape[1] for i in images), *images[0].shape[2:]), ground, np.uint8)
    x = 0
    for image in images:
        out[: image.shape[0], x : x + image.shape[1]] = image
        x += image.shape[1]
    return out


def bordered(image: np.ndarray, rows: int, columns: int, ground: int = 255) -> np.ndarray:
    return np.pad(image, [(rows, rows), (columns, columns)] + [(0, 0)] * (image.ndim - 2), constant_values=ground)


# Fixed value: bits of a tap's weight.
_TAP_BITS = 11


def _taps(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each of m new places the two old ones of n beside it and their weights; pixel centres are aligned, and places outside take the edge."""
    at = ((np.arange(m) + 0.5) * (n / m) - 0.5).astype(np.float32)
    low = np.floor(at).astype(np.int64)
    part = np.where((low < 0) | (low >= n - 1), np.float32(0), at - low)
    low = np.clip(low, 0, n - 1)
    one = np.float32(1 << _TAP_BITS)
    return low, np.minimum(low + 1, n - 1), np.rint((1 - part) * one).astype(np.int64), np.rint(part * one).astype(np.int64)


def resized(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear in fixed point, gray or in channels: taps of _TAP_BITS bits along rows, then down columns, with four bits dropped between and the sum rounded."""
    if image.shape[:2] == (height, width):
        return image.copy()
    (y0, y1, a0, a1), (x0, x1, b0, b1) = _taps(image.shape[0], height), _taps(image.shape[1], width)
    side = lambda w: w[:, None] if image.ndim == 3 else w
    x = image.astype(np.int64)
    rows = (x[:, x0] * side(b0) + x[:, x1] * side(b1)) >> 4
    down = lambda w: w.reshape(-1, *[1] * (image.ndim - 1))
    return (((rows[y0] * down(a0) >> 16) + (rows[y1] * down(a1) >> 16) + 2) >> 2).astype(np.uint8)


def png(image: np.ndarray) -> bytes:
    """A PNG file of a gray or BGR image."""
    colour = image.ndim == 3
    rows = np.ascontiguousarray(image[..., ::-1] if colour else image).reshape(image.shape[0], -1)
    raw = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 2 if colour else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")
