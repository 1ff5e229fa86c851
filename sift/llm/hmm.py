"""Hidden Markov chains over numbered symbols: likelihood and expected counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

# Symbols of sequences that are put side by side, and that are worked on at once.
POOL, BLOCK = 2**22, 2**16


@dataclass(frozen=True)
class Hmm:
    """`start[k]`, `move[k, l]`, and `emit[symbol, k]` as probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @property
    def states(self) -> int:
        return len(self.start)

    def single(self) -> Hmm:
        """The model in single precision."""
        return Hmm(*(x.astype(np.float32) for x in (self.start, self.move, self.emit)))


@dataclass
class Counts:
    """Expected counts, in the shapes of a model; they add up over sequences."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def of(cls, model: Hmm) -> Counts:
        return cls(*(np.zeros(x.shape) for x in (model.start, model.move, model.emit)))


@dataclass(frozen=True)
class Pool:
    """Sequences side by side, the longest first: all their first symbols, then
    all second ones, and so on, so that steps take all sequences at once."""

    symbols: np.ndarray
    bounds: np.ndarray  # of each step's symbols
    order: np.ndarray  # which sequence is at which place of a step

    @classmethod
    def of(cls, sequences: list[np.ndarray]) -> Pool:
        lengths = np.array([len(s) for s in sequences], np.int64)
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        ending = np.bincount(lengths, minlength=longest + 1)
        running = len(sequences) - np.cumsum(ending)[:longest]  # longer than the step
        bounds = np.concatenate([[0], np.cumsum(running)]).astype(np.int64)
        symbols = np.empty(bounds[-1], np.int32)
        for place, at in enumerate(order):
            symbols[bounds[: lengths[at]] + place] = sequences[at]
        return cls(symbols, bounds, order)

    def blocks(self, size: int) -> list[list[tuple[int, int]]]:
        """The bounds of all steps, in stretches of about `size` symbols."""
        found: list[list[tuple[int, int]]] = []
        for low, high in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True):
            if not found or high - found[-1][0][0] > size:
                found.append([])
            found[-1].append((low, high))
        return found


def forward(
    model: Hmm,
    seen: np.ndarray,
    steps: list[tuple[int, int]],
    state: np.ndarray | None,
    kept: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The chance of each symbol given those before it, and the states at the end.

    `seen` has the rows of `emit` from the first of `steps` on, `state` the
    chances before it. Chances are scaled to one at every step, so nothing
    underflows however long a sequence is. `kept` takes them all.
    """
    begin, ones = steps[0][0], np.ones(model.states, seen.dtype)
    scale = np.empty(len(seen), seen.dtype)
    for low, high in steps:
        low, high = low - begin, high - begin
        state = model.start if state is None else state[: high - low] @ model.move
        state = np.multiply(state, seen[low:high], out=None if kept is None else kept[low:high])
        total = np.matmul(state, ones, out=scale[low:high])
        state /= total[:, None]
    return scale, state


def log10_likelihood(model: Hmm, pool: Pool, size: int = BLOCK) -> np.ndarray:
    """Of each sequence, in the order they were given."""
    found, state = np.zeros(len(pool.order)), None
    for steps in pool.blocks(size):
        begin, end = steps[0][0], steps[-1][1]
        scale, state = forward(model, model.emit[pool.symbols[begin:end]], steps, state)
        running = [high - low for low, high in steps]
        place = np.arange(end - begin) - np.repeat([low - begin for low, _ in steps], running)
        found += np.bincount(place, np.log10(scale), len(found))
    back = np.empty_like(found)
    back[pool.order] = found
    return back


def expect(model: Hmm, pool: Pool, counts: Counts, size: int = BLOCK) -> None:
    """Add the expected counts of a pool's sequences.

    The forward pass keeps only the states between stretches of `size`
    symbols, and is run again inside each stretch when the backward pass comes
    to it. So what a pool takes is bounded, and stays in the processor's cache.
    """
    blocks = pool.blocks(size)
    entering: list[np.ndarray | None] = [None]
    for steps in blocks[:-1]:
        seen = model.emit[pool.symbols[steps[0][0] : steps[-1][1]]]
        entering.append(forward(model, seen, steps, entering[-1])[1].copy())
    back = np.ascontiguousarray(model.move.T)
    moves = np.zeros_like(counts.move)
    after = None
    for steps, state in zip(reversed(blocks), reversed(entering), strict=False):
        begin, end = steps[0][0], steps[-1][1]
        seen = model.emit[pool.symbols[begin:end]]
        chances = np.empty_like(seen)
        seen /= forward(model, seen, steps, state, chances)[0][:, None]
        for low, high in reversed(steps):
            now, here = chances[low - begin : high - begin], seen[low - begin : high - begin]
            if after is not None:
                # the sequences that go on come first; `after` says how likely
                # what follows is, from each state that they may move to
                going = len(after)
                moves += now[:going].T @ after
                likely = after @ back
                now[:going] *= likely
                here[:going] *= likely
            after = here
        # one symbol's places lie side by side, so that each sum is a stretch
        packed = pool.symbols[begin:end] * np.int64(2**32)
        packed += np.arange(end - begin)
        packed.sort()
        symbols = packed >> 32
        first = np.flatnonzero(np.diff(symbols, prepend=-1))
        sums = np.add.reduceat(chances[packed & (2**32 - 1)], first, axis=0)
        counts.emit[symbols[first]] += sums
        if begin == 0:
            counts.start += chances[: steps[0][1]].sum(axis=0)
    counts.move += moves * model.move


def pools(sequences: Iterable[np.ndarray], size: int = POOL) -> Iterator[Pool]:
    """Sequences put together until they have `size` symbols."""
    held: list[np.ndarray] = []
    symbols = 0
    for sequence in sequences:
        held.append(sequence)
        symbols += len(sequence)
        if symbols >= size:
            yield Pool.of(held)
            held, symbols = [], 0
    if held:
        yield Pool.of(held)


def first_model(weights: np.ndarray, states: int) -> Hmm:
    """States that tend to stay, and symbols by weight, with small differences
    between the states that are drawn once and for all."""
    draw = np.random.default_rng(20_240_613).random((len(weights), states))
    emit = weights[:, None] * (0.5 + draw)
    move = np.full((states, states), 0.2 / max(states - 1, 1)) + np.eye(states) * 0.8
    return Hmm(
        np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    )


def improved(counts: Counts, types: np.ndarray) -> Hmm:
    """The model that the expected counts ask for.

    `types` says how many words a symbol stands for; each is taken as seen
    once more, spread over the states like everything else. So summed over
    the states a symbol has the chance that adding one to the counts gives.
    """
    held = counts.emit.sum(axis=0)
    share = held / held.sum()
    emit = (counts.emit + types[:, None] * share) / (held + types.sum() * share)
    move, start = counts.move + 1, counts.start + 1
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit)
