"""Brute-force helpers of the tests in this folder."""


def exact_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    stopped = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        weight = sum(weights[s] for s in order if s not in stopped)
        above = {s for s in order if s not in stopped and weights[s] * left / weight > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in stopped else weights[s] * left / weight for s in order}
        stopped |= above
