"""A skip-chain conditional random field over the candidate tokens of documents.

Nodes are tokens, labels their kinds of personal data or none. A node's features give its own scores; tokens
that follow each other share chain potentials, by how far they are apart; and all tokens of a document that
show the same or a similar content share one hidden label, the hub, by skip potentials. A hub links any number
of repetitions with as many edges as there are tokens, so nothing is done for all pairs of them.

Inference is loopy sum-product message passing, damped, with a fixed number of rounds; all documents of a
block run together. On trees it is exact. Weights are learned by pseudo-likelihood: the sum over nodes of the
log probability of the label given its neighbours' labels, which is concave.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 12
DAMPING = 0.3


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def _normal(messages: np.ndarray) -> np.ndarray:
    return messages - _log_sum(messages, 1)[:, None]


@dataclass
class Graph:
    """Numbers of each node's features (-1: no further one); chain edges (left, right, distance class); hub of a
    node or -1, and edge class."""

    features: np.ndarray
    left: np.ndarray
    right: np.ndarray
    gap: np.ndarray
    hub: np.ndarray
    tie: np.ndarray  # 0: the node shows the hub's own content, 1: a similar one


@dataclass
class Model:
    nodes: np.ndarray  # features x labels, and a last row of zeros for number -1
    chain: np.ndarray  # distance classes x labels x labels
    skip: np.ndarray  # edge classes x labels (of the node) x labels (of the hub)

    @staticmethod
    def blank(features: int, labels: int, gaps: int, ties: int) -> Model:
        return Model(np.zeros((features + 1, labels)), np.zeros((gaps, labels, labels)), np.zeros((ties, labels, labels)))

    def marginals(self, graph: Graph, rounds: int = ROUNDS, damping: float = DAMPING) -> np.ndarray:
        """Probability of every label for every node."""
        own = self.nodes[graph.features].sum(axis=1)
        many, labels = own.shape
        chain = self.chain[graph.gap]
        member = np.flatnonzero(graph.hub >= 0)
        hub = graph.hub[member]
        hubs = int(hub.max(initial=-1)) + 1
        skip = self.skip[graph.tie[member]]
        flat = -np.log(labels)
        forward = np.full((len(graph.left), labels), flat)  # to the right node
        backward = forward.copy()
        up = np.full((len(member), labels), flat)  # to the hub
        down = up.copy()

        def belief() -> np.ndarray:
            total = own.copy()
            np.add.at(total, graph.right, forward)
            np.add.at(total, graph.left, backward)
            total[member] += down
            return total

        for _ in range(rounds):
            total = belief()
            new_forward = _normal(_log_sum((total[graph.left] - backward)[:, :, None] + chain, 1))
            new_backward = _normal(_log_sum((total[graph.right] - forward)[:, None, :] + chain, 2))
            new_up = _normal(_log_sum((total[member] - down)[:, :, None] + skip, 1))
            gathered = np.zeros((hubs, labels))
            np.add.at(gathered, hub, new_up)
            new_down = _normal(_log_sum((gathered[hub] - new_up)[:, None, :] + skip, 2))
            forward = _normal(damping * forward + (1 - damping) * new_forward)
            backward = _normal(damping * backward + (1 - damping) * new_backward)
            up = _normal(damping * up + (1 - damping) * new_up)
            down = _normal(damping * down + (1 - damping) * new_down)
        total = belief()
        return np.exp(total - _log_sum(total, 1)[:, None])


def other_labels(graph: Graph, labels: np.ndarray, kinds: int) -> np.ndarray:
    """What a node's hub is taken for while learning: the most frequent kind among its other tokens, 0 if none."""
    member = np.flatnonzero(graph.hub >= 0)
    hub = graph.hub[member]
    counts = np.zeros((int(hub.max(initial=-1)) + 1, kinds))
    np.add.at(counts, (hub, labels[member]), 1)
    others = counts[hub]
    others[np.arange(len(member)), labels[member]] -= 1
    others[:, 0] = 0.5
    return others.argmax(axis=1)


def fit(
    graph: Graph, labels: np.ndarray, features: int, kinds: int, gaps: int, ties: int, steps: int = 400, decay: float = 1e-4,
    counted: np.ndarray | None = None,
) -> Model:
    """Weights that maximise the pseudo-likelihood less ``decay`` / 2 times their squares, by adaptive gradients.

    Nodes that are not ``counted`` only serve as neighbours.
    """
    model = Model.blank(features, kinds, gaps, ties)
    if not len(labels):
        return model
    member = np.flatnonzero(graph.hub >= 0)
    hubs = other_labels(graph, labels, kinds)
    tie = graph.tie[member]
    truth = np.eye(kinds)[labels]
    active = np.zeros((len(labels), features + 1), dtype=np.float32)
    active[np.arange(len(labels))[:, None], graph.features] = 1
    active[:, -1] = 0
    weights = (model.nodes, model.chain, model.skip)
    memory = [np.full_like(w, 1e-6) for w in weights]
    for _ in range(steps):
        scores = active @ model.nodes
        np.add.at(scores, graph.right, model.chain[graph.gap, labels[graph.left]])
        np.add.at(scores, graph.left, model.chain[graph.gap, :, labels[graph.right]])
        scores[member] += model.skip[tie, :, hubs]
        wrong = np.exp(scores - _log_sum(scores, 1)[:, None]) - truth
        if counted is not None:
            wrong[~counted] = 0
        nodes = active.T @ wrong
        chain = np.zeros_like(model.chain)
        np.add.at(chain, (graph.gap, labels[graph.left]), wrong[graph.right])
        np.add.at(chain.transpose(0, 2, 1), (graph.gap, labels[graph.right]), wrong[graph.left])
        skip = np.zeros_like(model.skip)
        np.add.at(skip.transpose(0, 2, 1), (tie, hubs), wrong[member])
        for weight, slope, held in zip(weights, (nodes, chain, skip), memory):
            slope = slope / len(labels) + decay * weight
            held += slope * slope
            weight -= 0.3 * slope / np.sqrt(held)
    return model
