"""Operator 1 - main text by a linear-chain CRF over DOM leaf blocks.

A page is parsed into its leaf blocks: runs of text that no block-level tag
interrupts, each below a path of ancestors.  A block's features are the tags
and the class, id and role words along the path and the shape of its text; the
chain's states are main text or not, with transitions that know whether two
blocks share their container.  Weights are trained on labelled pages by the
gradient of the conditional likelihood (forward-backward), pages are decoded by
Viterbi.

Every page is read on its own and whole: no shuffle, nothing collected.
Defined cases: null or empty html, and pages without main text, give an empty
text; broken mark-up is closed as browsers do (an unfinished tag, comment or
script ends with the page); repeated rows give equal results; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.html_pages import labelled_pages

#: Size of the training set and steps of the fit.
TRAIN_PAGES = 500
STEPS = 120
RATE = 0.15
PENALTY = 1e-3
CACHED_PATHS = 50_000

# Fixed values of HTML: which elements make blocks, hold no text, or close others.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search
section select summary table tbody td template tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4
h5 h6 header hgroup hr main menu nav ol p pre search section table ul""".split())
SCOPE = frozenset("table td th caption button template html".split())
#: element: (what its start tag closes, where the search for it stops)
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# possessive throughout: a tag that never ends is read once
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|</?[a-zA-Z][^>]*+\Z|[^<]++|<""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Block:
    text: str
    path: int
    container: int
    linked: int  # characters of it inside links
    label: int


class Parser:
    """Pages to blocks; paths are numbered once for a worker.  Labels are read
    from training pages only."""

    def __init__(self, labelled: bool = False) -> None:
        self.labelled = labelled
        self.paths: dict[tuple, int] = {}
        self.features: list[tuple[str, ...]] = []
        self.root = self._path(-1, "", ())

    def _path(self, parent: int, tag: str, words: tuple[str, ...]) -> int:
        key = (parent, tag, words)
        at = self.paths.get(key)
        if at is None:
            at = self.paths[key] = len(self.features)
            above = tuple(f for f in self.features[parent] if f[0] != "p") if parent >= 0 else ()
            own = tuple(f"c:{w}" for w in words)
            self.features.append(tuple(dict.fromkeys((*above, f"t:{tag}", *own, *(f"{w}" for w in (f"p:{tag}", *(f"pc:{w}" for w in words)))))) if tag else ())
        return at

    def blocks(self, page: str) -> list[Block]:
        out: list[Block] = []
        texts: list[str] = []
        linked, in_link, serial, pos, size = 0, False, 0, 0, len(page)
        # element: (tag, path, serial number, label)
        stack: list[tuple[str, int, int, int]] = [("", self.root, 0, 0)]

        def flush() -> None:
            nonlocal linked
            if texts:
                text = " ".join(unescape("".join(texts)).split())
                texts.clear()
                if text:
                    tag, path, number, label = stack[-1]
                    inner = tag in ("p", "li", "td", "th", "dd", "dt") or tag in HEADINGS
                    out.append(Block(text, path, stack[-2][2] if inner and len(stack) > 1 else number, min(linked, len(text)), label))
            linked = 0

        def close(tags: frozenset | set, stops: frozenset | set, all_of_them: bool = False) -> None:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in tags:
                    del stack[i:]
                    if not all_of_them:
                        return
                elif stack[i][0] in stops:
                    return

        match = _TOKEN.match
        while pos < size:
            m = match(page, pos)
            pos = m.end()
            name = m[2] or m[5]
            if name is None:
                piece = m[0]
                if piece[0] != "<" or piece == "<":
                    texts.append(piece)
                    if in_link:
                        linked += len(piece)
                continue
            name = name.lower()
            if m[1] or m[4]:  # an end tag
                if name == "a":
                    in_link = False
                elif name in BLOCK:
                    flush()
                    close({name}, SCOPE - {name} if name not in ("body", "html") else set())
                continue
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, pos)
                pos = end.start() if end else size
                if name == "textarea":
                    flush()
                continue
            if name == "a":
                in_link = True
            elif name == "br":
                texts.append(" ")
            elif name in BLOCK:
                flush()
                if name in ENDS_P:
                    close({"p"}, SCOPE)
                if name in ENDS:
                    close(ENDS[name][0], ENDS[name][1], name in ("tr", "tbody", "tfoot"))
                if name in HEADINGS and stack[-1][0] in HEADINGS:
                    stack.pop()
                if name in VOID:
                    continue
                words, label = (), stack[-1][3]
                attributes = m[3] or m[6]
                if attributes and not attributes.isspace():
                    words, label = self._words(attributes, label)
                serial += 1
                stack.append((name, self._path(stack[-1][1], name, words), serial, label))
        flush()
        return out

    def _words(self, attributes: str, label: int) -> tuple[tuple[str, ...], int]:
        words: list[str] = []
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                words += [w.lower() for w in _WORD.findall(value)]
            elif name == "role":
                words.append(f"role={value.strip().lower()}")
            elif name in ("hidden",) or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                words.append("hidden=")
            elif self.labelled and name == "data-y":
                label = int(value)
        return tuple(sorted(set(words))), label


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


def text_features(text: str, linked: int) -> list[str]:
    n = text.count(" ") + 1
    out = ["bias", f"n{_bucket(n, (2, 3, 5, 9, 16, 31))}", f"l{_bucket(100 * linked // len(text), (1, 30, 80))}", f"e{text[-1] in '.!?:…»”'}", f"k{min(text.count(','), 3)}"]
    if "©" in text:
        out.append("copyright")
    if n <= 8:
        out.append("digits" if any(c.isdigit() for c in text) else "nodigits")
    return out


class Model:
    """Weights of features for main text, and the transitions [shared
    container][from][to]."""

    def __init__(self, weight: dict[str, float], moves: np.ndarray):
        self.weight, self.moves = weight, moves.tolist()

    def decode(self, gains: list[float], same: list[bool]) -> list[bool]:
        """Viterbi: which blocks are main text."""
        if not gains:
            return []
        zero, one, back = 0.0, gains[0], []
        for g, s in zip(gains[1:], same[1:]):
            (a, b), (c, d) = self.moves[s]
            from_zero, from_one = zero + a >= one + c, zero + b >= one + d
            back.append((from_zero, from_one))
            zero, one = max(zero + a, one + c), max(zero + b, one + d) + g
        state, out = one > zero, []
        for from_zero, from_one in reversed(back):
            out.append(state)
            state = not (from_one if state else from_zero)
        return [*reversed([*out, state])]


def _same(blocks: list[Block]) -> list[bool]:
    return [False, *(a.container == b.container for a, b in zip(blocks, blocks[1:]))]


def fit(pages: list[str], steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Model:
    """Train on pages whose elements carry ``data-y`` labels."""
    parser, index = Parser(labelled=True), {}
    chains = [c for c in (parser.blocks(p) for p in pages) if c]
    n, width = len(chains), max(map(len, chains))
    ids, starts, gold, mask, shared = [], [], np.zeros((n, width), dtype=np.int64), np.zeros((n, width), dtype=bool), np.zeros((n, width), dtype=np.int64)
    cell = []
    for i, chain in enumerate(chains):
        shared[i, :len(chain)] = _same(chain)
        for t, b in enumerate(chain):
            starts.append(len(ids))
            cell.append(i * width + t)
            ids += [index.setdefault(f, len(index)) for f in (*parser.features[b.path], *text_features(b.text, b.linked))]
            gold[i, t], mask[i, t] = b.label, True
    ids, starts, cell = np.array(ids), np.array(starts), np.array(cell)
    row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
    w, moves = np.zeros(len(index)), np.zeros((2, 2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(moves), np.zeros_like(moves)]
    pick = np.arange(2)
    seen = mask[:, 1:]
    want = np.zeros((2, 2, 2))
    np.add.at(want, (shared[:, 1:][seen], gold[:, :-1][seen], gold[:, 1:][seen]), 1)
    for step in range(1, steps + 1):
        gain = np.zeros(n * width)
        gain[cell] = np.add.reduceat(w[ids], starts)
        emit = np.zeros((n, width, 2))
        emit[:, :, 1] = gain.reshape(n, width)
        # forward and backward in logs; behind a chain's end nothing changes
        forward = np.zeros((n, width, 2))
        forward[:, 0] = emit[:, 0]
        for t in range(1, width):
            step_in = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves[shared[:, t]], axis=1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], step_in, forward[:, t - 1])
        backward = np.zeros((n, width, 2))
        for t in range(width - 2, -1, -1):
            out = np.logaddexp.reduce(moves[shared[:, t + 1]] + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(mask[:, t + 1, None], out, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        share = np.exp(forward + backward - total[:, None, None])[:, :, 1]
        error = (gold - share).reshape(-1)[cell]
        slope = np.bincount(ids, error[row], minlength=len(w)) / n - penalty * w
        pair = np.exp(forward[:, :-1, :, None] + moves[shared[:, 1:]] + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])
        have = np.zeros((2, 2, 2))
        for s in pick:
            have[s] = pair[seen & (shared[:, 1:] == s)].sum(0)
        slope_moves = (want - have) / n - penalty * moves
        for x, g, m, v in ((w, slope, 0, 1), (moves, slope_moves, 2, 3)):  # Adam
            state[m] += 0.1 * (g - state[m])
            state[v] += 0.01 * (g * g - state[v])
            x += rate * (state[m] / (1 - 0.9**step)) / (np.sqrt(state[v] / (1 - 0.99**step)) + 1e-8)
    return Model({f: float(w[i]) for f, i in index.items()}, moves)


class Extractor:
    """A worker's parser and scores."""

    def __init__(self, model: Model):
        self.model = model
        self._begin()

    def _begin(self) -> None:
        self.parser, self.path_gain = Parser(), []

    def main_blocks(self, page: str) -> list[str]:
        if len(self.parser.features) > CACHED_PATHS:
            self._begin()
        blocks, weight, gain = self.parser.blocks(page), self.model.weight, self.path_gain
        for f in self.parser.features[len(gain):]:
            gain.append(sum(weight.get(x, 0.0) for x in f))
        gains = [gain[b.path] + sum([weight.get(x, 0.0) for x in text_features(b.text, b.linked)]) for b in blocks]
        return [b.text for b, y in zip(blocks, self.model.decode(gains, _same(blocks))) if y]


def extract(pages: DataFrame, model: Model | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (key, url, text, n_blocks)."""
    model = model or fit(labelled_pages(TRAIN_PAGES))
    names = [key, url]
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(model)
        for b in batches:
            found = [extractor.main_blocks(h) if h else [] for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(["\n".join(x) for x in found], pa.string()), pa.array([len(x) for x in found], pa.int64())], names=[*names, "text", "n_blocks"])

    return pages.select(key, url, F.col(html).cast("string").alias("html")).mapInArrow(run, f"{kinds}, text string, n_blocks long")
