"""Linear-chain conditional random fields over long sequences, for numpy.

Several sequences are laid end to end; where one begins, the chain is cut (``begins``). The chain is split into
blocks of equal length that advance in step: what a block does to any state before it is a small matrix, the
matrices are composed from block to block, and then all blocks run at once from the states before them. That gives
the same as one pass over each sequence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 256


@dataclass
class Chain:
    """Transition scores between labels, and of the first label."""

    moves: np.ndarray
    first: np.ndarray


def _blocks(scores: np.ndarray, begins: np.ndarray, fill: float) -> tuple[np.ndarray, np.ndarray]:
    """Both as (step, block, ...); the end is filled up with sequences of one."""
    more = -len(scores) % BLOCK
    scores = np.concatenate([scores, np.full((more, scores.shape[1]), fill, dtype=scores.dtype)])
    begins = np.concatenate([begins, np.ones(more, dtype=bool)])
    return (
        np.ascontiguousarray(scores.reshape(-1, BLOCK, scores.shape[1]).transpose(1, 0, 2)),
        np.ascontiguousarray(begins.reshape(-1, BLOCK).T),
    )


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.max(axis=-1, keepdims=True)


def marginals(chain: Chain, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The probability of each label at each position, by forward-backward."""
    n, labels = scores.shape
    if not n:
        return scores
    weights, cut = _blocks(np.exp(scores - scores.max(axis=1, keepdims=True)), begins, 1.0)
    moves = np.exp(chain.moves - chain.moves.max()).astype(scores.dtype)
    first = np.exp(chain.first - chain.first.max()).astype(scores.dtype)
    blocks = weights.shape[1]

    def forward(state: np.ndarray, k: int) -> np.ndarray:
        """One step of (block, ..., label)."""
        shape = (blocks,) + (1,) * (state.ndim - 1)
        onward = (state.reshape(-1, labels) @ moves).reshape(state.shape)
        onward = np.where(cut[k].reshape(shape), first * state.sum(-1, keepdims=True), onward)
        return onward * weights[k].reshape((blocks,) + (1,) * (state.ndim - 2) + (labels,))

    maps = np.tile(np.eye(labels, dtype=scores.dtype), (blocks, 1, 1))
    for k in range(BLOCK):
        maps = forward(maps, k)
        if k % 16 == 15:
            maps = maps / maps.max(axis=(1, 2), keepdims=True)
    before = np.empty((blocks, labels), dtype=scores.dtype)
    after = np.empty((blocks, labels), dtype=scores.dtype)
    state = np.full(labels, 1 / labels, dtype=scores.dtype)
    for b in range(blocks):
        before[b] = state
        state = state @ maps[b]
        state = state / state.max()
    state = np.ones(labels, dtype=scores.dtype)
    for b in range(blocks - 1, -1, -1):
        after[b] = state
        state = maps[b] @ state
        state = state / state.max()
    found = np.empty_like(weights)
    state = before
    for k in range(BLOCK):
        state = found[k] = _scaled(forward(state, k))
    state = after
    for k in range(BLOCK - 1, -1, -1):
        found[k] *= state
        ahead = state * weights[k]
        cut_off = (ahead * first).sum(-1, keepdims=True)
        state = _scaled(np.where(cut[k][:, None], cut_off, ahead @ moves.T))
    found /= found.sum(axis=-1, keepdims=True)
    return found.transpose(1, 0, 2).reshape(-1, labels)[:n]


def best_labels(chain: Chain, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The most probable labels, by Viterbi; of equal ones the last step's smallest label, then that before it."""
    n, labels = scores.shape
    if not n:
        return np.zeros(0, dtype=np.int8)
    steps, cut = _blocks(scores, begins, 0.0)
    blocks = steps.shape[1]

    def forward(state: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """One step of (block, ..., label), and the label each comes from."""
        onward = state[..., :, None] + chain.moves
        anew = state[..., :, None] + chain.first
        shape = (blocks,) + (1,) * state.ndim
        onward = np.where(cut[k].reshape(shape), anew, onward)
        step = steps[k].reshape((blocks,) + (1,) * (state.ndim - 2) + (labels,))
        return onward.max(axis=-2) + step, onward.argmax(axis=-2).astype(np.int8) if state.ndim == 2 else onward[:0]

    maps = np.where(np.eye(labels, dtype=bool), 0.0, -1e18).astype(scores.dtype)
    maps = np.tile(maps, (blocks, 1, 1))
    for k in range(BLOCK):
        maps, _ = forward(maps, k)
    before = np.empty((blocks, labels), dtype=scores.dtype)
    state = np.zeros(labels, dtype=scores.dtype)
    for b in range(blocks):
        before[b] = state
        state = (state[:, None] + maps[b]).max(axis=0)
        state = state - state.max()
    last = np.empty(blocks, dtype=np.int8)
    label = int(state.argmax())
    for b in range(blocks - 1, -1, -1):
        last[b] = label
        label = int((before[b] + maps[b][:, label]).argmax())
    state, came = before, np.empty((BLOCK, blocks, labels), dtype=np.int8)
    for k in range(BLOCK):
        state, came[k] = forward(state, k)
    found = np.empty((BLOCK, blocks), dtype=np.int8)
    each, label = np.arange(blocks), last
    for k in range(BLOCK - 1, -1, -1):
        found[k] = label
        label = came[k][each, label]
    return found.T.reshape(-1)[:n]


def gradient(chain: Chain, scores: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the log-likelihood of labels (sequence, step), given scores (sequence, step, label): by score, move, first."""
    count, length, labels = scores.shape
    moves, first = np.exp(chain.moves), np.exp(chain.first)
    weights = np.exp(scores - scores.max(axis=2, keepdims=True))
    ahead, behind = np.empty_like(weights), np.empty_like(weights)
    state = _scaled(weights[:, 0] * first)
    ahead[:, 0] = state
    for k in range(1, length):
        state = ahead[:, k] = _scaled((state @ moves) * weights[:, k])
    state = behind[:, -1] = np.ones((count, labels))
    for k in range(length - 1, 0, -1):
        state = behind[:, k - 1] = _scaled((state * weights[:, k]) @ moves.T)
    one = ahead * behind
    one /= one.sum(axis=2, keepdims=True)
    two = ahead[:, :-1, :, None] * moves * (weights * behind)[:, 1:, None, :]
    two /= two.sum(axis=(2, 3), keepdims=True)
    truth = np.eye(labels)[gold]
    by_move = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:]) - two.sum(axis=(0, 1))
    return truth - one, by_move, (truth[:, 0] - one[:, 0]).sum(axis=0)
