"""Main text of a page: a linear-chain conditional random field over its text blocks."""

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.html_blocks import Block, Page, parse
from tideline.llm.html_pages import KINDS, labelled_pages

#: What a class word says about a part, for words that stand for one kind of part.
_KIND = {f".{w}": f"kind={k}" for k, names in KINDS.items() for name in names.split() for w in name.split("-")}
_ENDS = (".", "!", "?", "…", ":", '"', "”", "»")


def features(block: Block) -> set[str]:
    """What the model sees of a block: the tags and class words around it, its parent, and the shape of its text."""
    text, n = block.text, len(block.text)
    words = text.count(" ") + 1
    out = set(block.marks)
    out.update(_KIND[m] for m in block.marks if m in _KIND)
    out.add("parent=" + block.parent)
    out.add(f"words={min(words.bit_length(), 7)}")
    out.add(f"links={min(4, block.link_chars * 4 // max(1, n))}")
    out.add("ends" if text.endswith(_ENDS) else "open")
    if "," in text or ". " in text:
        out.add("sentences")
    if "©" in text or "copyright" in text.lower():
        out.add("rights")
    if "|" in text or "·" in text:
        out.add("bars")
    if not any(c.isalnum() for c in text):
        out.add("no word")
    return out


class Extractor:
    """Weights of the labels main (1) and other (0): per feature, start and transitions."""

    def __init__(self, weights: dict[str, float], start: np.ndarray, steps: np.ndarray):
        self.weights = weights
        self._start, self._steps = start.tolist(), steps.tolist()

    def decode(self, page: Page) -> list[bool]:
        """The likeliest labels by Viterbi; of equally likely paths the one with fewer main blocks at its end."""
        get, path, score = self.weights.get, [], None
        (a, b), (c, d) = self._steps
        for block in page.blocks:
            gain = sum(get(f, 0.0) for f in features(block))
            if score is None:
                score = (self._start[0], self._start[1] + gain)
                path.append((0, 0))
                continue
            from0, from1 = score
            other, main = (from0 + a, from1 + c), (from0 + b, from1 + d)
            path.append((int(other[1] > other[0]), int(main[1] > main[0])))
            score = (max(other), max(main) + gain)
        labels: list[bool] = []
        now = int(score is not None and score[1] > score[0])
        for back in reversed(path):
            labels.append(bool(now))
            now = back[now]
        return labels[::-1]

    def main_text(self, source: str | None) -> str:
        page = parse(source)
        return "\n\n".join(b.text for b, main in zip(page.blocks, self.decode(page), strict=True) if main)


def fit(pages: Sequence[str], rounds: int = 150, ridge: float = 0.1, rate: float = 0.3) -> Extractor:
    """Maximum-likelihood weights from pages whose blocks carry data-main labels; blocks without one count as other.

    The pages' forward and backward sums run side by side, padded to the longest page; steps follow Adam.
    """
    parsed = [p.blocks for p in map(parse, pages) if p.blocks]
    names = sorted({f for blocks in parsed for b in blocks for f in features(b)})
    number = {f: i for i, f in enumerate(names)}
    n, longest = len(parsed), max(map(len, parsed), default=0)
    if not n:
        return Extractor({}, np.zeros(2), np.zeros((2, 2)))
    cell, feature = [], []
    truth = np.zeros((n, longest), dtype=int)
    real = np.zeros((n, longest), dtype=bool)
    for i, blocks in enumerate(parsed):
        for t, b in enumerate(blocks):
            ids = [number[f] for f in features(b)]
            cell += [i * longest + t] * len(ids)
            feature += ids
            truth[i, t], real[i, t] = int(bool(b.main)), True
    cell, feature = np.array(cell), np.array(feature)
    length = real.sum(axis=1)
    w = np.zeros(len(names) + 6)
    mean, spread = np.zeros_like(w), np.zeros_like(w)
    pairs = real[:, 1:]
    seen_steps = np.array(
        [[((truth[:, :-1] == a) & (truth[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)], dtype=float
    )
    seen_start = np.array([(truth[:, 0] == 0).sum(), (truth[:, 0] == 1).sum()], dtype=float)
    seen_features = np.bincount(feature, weights=truth.ravel()[cell], minlength=len(names))
    for step in range(1, rounds + 1):
        start, steps = w[-6:-4], w[-4:].reshape(2, 2)
        emit = np.zeros((n, longest, 2))
        emit[:, :, 1] = np.bincount(cell, weights=w[:-6][feature], minlength=n * longest).reshape(n, longest)
        forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        forward[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            moved = np.logaddexp.reduce(forward[:, t - 1, :, None] + steps, axis=1) + emit[:, t]
            forward[:, t] = np.where(real[:, t, None], moved, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = np.logaddexp.reduce(steps + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(real[:, t + 1, None], moved, 0.0)
        total = np.logaddexp.reduce(forward[np.arange(n), length - 1], axis=1)
        inner = np.exp(np.minimum(forward + backward - total[:, None, None], 0)) * real[:, :, None]
        both = forward[:, :-1, :, None] + steps + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
        both = np.exp(np.minimum(both, 0)) * pairs[:, :, None, None]
        slope = np.concatenate([
            seen_features - np.bincount(feature, weights=inner[:, :, 1].ravel()[cell], minlength=len(names)),
            seen_start - inner[:, 0].sum(axis=0),
            (seen_steps - both.sum(axis=(0, 1))).ravel(),
        ])
        slope -= ridge * w
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        w += rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        rate *= 0.98
    return Extractor(dict(zip(names, w[:-6].tolist(), strict=True)), w[-6:-4], w[-4:].reshape(2, 2))


@lru_cache(maxsize=1)
def trained() -> Extractor:
    """The extractor fitted to the labelled pages of this package."""
    return fit(labelled_pages())


def main_text(source: Column, extractor: Extractor) -> Column:
    """The page's main text: its main blocks in page order, joined by two line breaks.

    A null or empty page, and one without a main block, gives the empty text. Pages of any length are read whole.
    """

    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([extractor.main_text(p) for p in pages], dtype=object)

    return F.pandas_udf(extracted, T.StringType())(source)
