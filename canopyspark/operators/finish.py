"""Finishing of pictures: denoising, and the fixed order of all steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from canopyspark.operators import pixels as px
from canopyspark.operators.contrast import locally_contrasted
from canopyspark.operators.tiles import by_tiles, mirrored

def bilateral(image: np.ndarray, radius: int, sigma_colour: float, sigma_space: float) -> np.ndarray:
    """Means over a disc with mirrored borders, weighted by distance and by difference of colour (the sum over the last axis)."""
    h, w, _ = image.shape
    around = np.stack([mirrored(image[:, :, c], radius) for c in range(image.shape[2])], axis=2)
    total, weight = np.zeros_like(image), np.zeros((h, w, 1))
    for dy in range(-radius, radius + 1):
        for dx in range(-radius, radius + 1):
            if dx * dx + dy * dy <= radius * radius:
                other = around[radius + dy : radius + dy + h, radius + dx : radius + dx + w]
                far = np.abs(other - image).sum(axis=2, keepdims=True)
                own = np.exp(-(far * far) / (2 * sigma_colour**2) - (dx * dx + dy * dy) / (2 * sigma_space**2))
                total += own * other
                weight += own
    return total / weight


def denoised(pixels: DataFrame, radius: int = 2, sigma_colour: float = 25.0, sigma_space: float = 25.0) -> DataFrame:
    """r, g, b by bilateral means, rounded."""

    def kernel(arrays, there):
        image = np.stack([arrays[c].astype(float) for c in "rgb"], axis=2)
        out = np.clip(np.rint(bilateral(image, radius, sigma_colour, sigma_space)), 0, 255).astype(np.int32)
        return {c: out[:, :, k] for k, c in enumerate("rgb")}

    return by_tiles(pixels, ["r", "g", "b"], radius, kernel, dict.fromkeys("rgb", "int"))


def finished(pixels: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Contrast, white balance, denoising, sharpening and, with a reference, colour match, in this order: image_key, x, y, r, g, b."""
    out = px.white_balanced(locally_contrasted(pixels.select("image_key", "x", "y", "r", "g", "b")))
    out = denoised(out.select("image_key", "x", "y", "r", "g", "b"))
    out = px.sharpened(out, ["r", "g", "b"], ["r", "g", "b"], kernel=px.gaussian_kernel(1.2))
    return px.colour_matched(out, reference) if reference is not None else out
