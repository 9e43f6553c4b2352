"""A linear-chain conditional random field over the blocks of a page, with two labels."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from footfall.llm.html_blocks import Block, Element, leaf_blocks
from footfall.llm.page_layouts import labelled_pages

#: Labelled pages that are learned from, their seed, steps of the optimiser and strength of the penalty.
PAGES, SEED, STEPS, PENALTY = 800, 11, 150, 0.02


class Model(NamedTuple):
    """Scores of the label "article" against "other": per feature, at the ends, and per pair of neighbours."""

    weights: dict[str, float]
    first: float
    last: float
    steps: list[list[float]]  # from label, to label


def path_features(path: tuple[Element, ...]) -> list[str]:
    """What the elements around a block say: tags, names, and tags with their parents' tags."""
    tags = [e.tag for e in path if e.tag not in ("html", "body")]
    found = {f"tag={t}" for t in tags}
    found |= {f"under={a}>{b}" for a, b in zip(tags, tags[1:])}
    found |= {f"name={n}" for e in path for n in e.names}
    found |= {f"named={e.tag}.{n}" for e in path if e.tag not in ("html", "body") for n in e.names}
    leaf = tags[-1] if tags else ""
    return [f"leaf={leaf}", f"depth={min(len(tags), 6)}", *sorted(found)]


def text_features(block: Block) -> list[str]:
    """Shape of the text: its words, its links, its end."""
    size = block.text.count(" ") + 1
    length = next(str(n) for n in (1, 2, 4, 8, 16, 32, 64, 1 << 62) if size <= n)
    share = block.linked / len(block.text)
    links = "all" if share > 0.9 else "half" if share > 0.4 else "some" if share > 0 else "none"
    ended = block.text[-1] in ".!?…。:"
    return [f"words={length}", f"links={links}", f"ended={ended}", f"words={length},links={links}", f"words={length},ended={ended}",
            *(["sign"] if "©" in block.text else [])]


def _examples(pages) -> list[tuple[list[list[str]], list[int]]]:
    out = []
    for html, truth in pages:
        blocks, labels = leaf_blocks(html), []
        at = 0
        for block in blocks:
            # Text that the page's markup runs together takes the label of where it begins.
            while at + 1 < len(truth) and not block.text.startswith(truth[at][0]):
                at += 1
            labels.append(int(truth[at][1]))
            at += at + 1 < len(truth)
        if blocks:
            out.append(([path_features(b.path) + text_features(b) for b in blocks], labels))
    return out


def train(pages: int = PAGES, seed: int = SEED, steps: int = STEPS, penalty: float = PENALTY) -> Model:
    """The model of greatest penalised likelihood over labelled pages, by gradient steps of adaptive length.

    The pages are few and fixed by the parameters, whatever the table holds. All of them are
    worked on at once, place by place.
    """
    examples = _examples(labelled_pages(pages, seed))
    names: dict[str, int] = {}
    for rows, _ in examples:
        for row in rows:
            for name in row:
                names.setdefault(name, len(names))
    longest, number = max(len(labels) for _, labels in examples), len(examples)
    used, owner, gold = [], [], np.full((number, longest), -1)
    for page, (rows, labels) in enumerate(examples):
        gold[page, : len(labels)] = labels
        for place, row in enumerate(rows):
            used += [names[n] for n in row]
            owner += [page * longest + place] * len(row)
    used, owner = np.array(used), np.array(owner)
    there, last = gold >= 0, (gold >= 0).sum(axis=1) - 1
    every = np.arange(number)
    # Parameters: features, the two ends, then the four pairs.
    size = len(names) + 6
    want = np.zeros(size)
    want[: len(names)] = np.bincount(used, gold.ravel()[owner] == 1, minlength=len(names))
    want[-6], want[-5] = (gold[:, 0] == 1).sum(), (gold[every, last] == 1).sum()
    both = there[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            want[-4 + 2 * a + b] = ((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum()

    theta, moment, spread = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        score = np.zeros((number, longest, 2))
        score[:, :, 1] = np.bincount(owner, theta[used], minlength=number * longest).reshape(number, longest)
        score[:, 0, 1] += theta[-6]
        score[every, last, 1] += theta[-5]
        moves = theta[-4:].reshape(2, 2)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = score[:, t] + np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1])
        for t in range(longest - 2, -1, -1):
            after = score[:, t + 1] + back[:, t + 1]
            way = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
            back[:, t] = np.where((t < last)[:, None], way, 0.0)
        total = np.logaddexp(*ahead[every, last].T)
        share = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None]) * there
        have = np.zeros(size)
        have[: len(names)] = np.bincount(used, share.ravel()[owner], minlength=len(names))
        have[-6], have[-5] = share[:, 0].sum(), share[every, last].sum()
        for a in (0, 1):
            for b in (0, 1):
                pair = ahead[:, :-1, a] + moves[a, b] + score[:, 1:, b] + back[:, 1:, b] - total[:, None]
                have[-4 + 2 * a + b] = (np.exp(np.where(both, pair, -np.inf))).sum()
        slope = want - have - penalty * theta
        moment += (slope - moment) * 0.1
        spread += (slope**2 - spread) * 0.01
        theta += 0.2 * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
    return Model(dict(zip(names, theta.tolist())), float(theta[-6]), float(theta[-5]), theta[-4:].reshape(2, 2).tolist())


class Labeller:
    """Viterbi decoding. What a path scores is remembered, as blocks of a page share few."""

    REMEMBERED = 1 << 14

    def __init__(self, model: Model):
        self.model, self.paths, self.shapes = model, {}, {}

    def _path(self, path: tuple[Element, ...]) -> float:
        score = self.paths.get(path)
        if score is None:
            if len(self.paths) >= self.REMEMBERED:
                self.paths.clear()
            score = self.paths[path] = sum(self.model.weights.get(f, 0.0) for f in path_features(path))
        return score

    def score(self, block: Block) -> float:
        return self._path(block.path) + sum(self.model.weights.get(f, 0.0) for f in text_features(block))

    def labels(self, blocks: list[Block]) -> list[int]:
        """1 for blocks of the article, on the most likely way through the page; of equal ways, other."""
        if not blocks:
            return []
        (s00, s01), (s10, s11) = self.model.steps
        scores = [self.score(b) for b in blocks]
        scores[0] += self.model.first
        scores[-1] += self.model.last
        other, own, came = 0.0, scores[0], []
        for score in scores[1:]:
            to_other = (other + s00, own + s10)
            to_own = (other + s01, own + s11)
            came.append((to_other[1] > to_other[0], to_own[1] > to_own[0]))
            other, own = max(to_other), max(to_own) + score
        label, out = int(own > other), []
        for step in reversed(came):
            out.append(label)
            label = int(step[label])
        out.append(label)
        return out[::-1]
