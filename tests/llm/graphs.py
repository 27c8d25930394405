"""Components by brute force."""

from __future__ import annotations


def components(nodes: list, links: list[tuple]) -> dict:
    """The smallest node that links lead to, for each node."""
    lowest = {node: node for node in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(lowest[a], lowest[b])
            changed = changed or lowest[a] != low or lowest[b] != low
            lowest[a] = lowest[b] = low
    return lowest
