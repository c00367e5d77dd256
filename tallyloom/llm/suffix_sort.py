"""Deep-shallow sorting of strings that share a long prefix, with the lengths they have in common.

Multikey quicksort orders the strings to a shallow depth. Groups still equal there go into a
blind trie, which holds only the positions where strings part: a new string is led down by those
positions alone, compared once with a string found there, and hung in where it differs.
"""

SHALLOW = 16


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Node:
    __slots__ = ("depth", "children", "sample")

    def __init__(self, depth: int, sample: int):
        self.depth, self.children, self.sample = depth, {}, sample


def _blind(strings: list[bytes], group: list[int], order: list[int], lengths: list[int], first: int) -> None:
    """Sort a group by a blind trie; ``first`` is what its first string has in common with the one before."""
    key = lambda s, depth: s[depth] if depth < len(s) else -1  # noqa: E731  an end comes before any byte
    root = _Node(len(strings[group[0]]), group[0])
    same = {group[0]: [group[0]]}
    for k in group[1:]:
        s = strings[k]
        node = root
        while node.children:
            child = node.children.get(key(s, node.depth))
            if child is None:
                break
            node = child
        shared = common(s, strings[node.sample])
        if shared == len(s) == len(strings[node.sample]) and not node.children:
            same[node.sample].append(k)
            continue
        above, node = None, root
        while node.children and node.depth < shared:
            above, node = node, node.children[key(s, node.depth)]
        if not (node.children and node.depth == shared):
            split = _Node(shared, node.sample)
            split.children[key(strings[node.sample], shared)] = node
            if above is None:
                root = split
            else:
                above.children[key(s, above.depth)] = split
            node = split
        node.children[key(s, shared)] = _Node(len(s), k)
        same[k] = [k]
    waiting = [(root, first)]
    while waiting:
        node, shared = waiting.pop()
        if node.children:
            inner = sorted(node.children.items())
            for n, (_, child) in reversed(list(enumerate(inner))):
                waiting.append((child, node.depth if n else shared))
        else:
            for n, k in enumerate(same[node.sample]):
                order.append(k)
                lengths.append(len(strings[k]) if n else shared)


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, common): the sorted order, and what each string has in common with the one before it in that order."""
    order: list[int] = []
    lengths: list[int] = []

    def leaf(group: list[int]) -> None:
        first = common(strings[group[0]], strings[order[-1]]) if order else 0
        if len(group) == 1:
            order.append(group[0])
            lengths.append(first)
        else:
            _blind(strings, group, order, lengths, first)

    # multikey quicksort, eight bytes as one key; a stack in place of recursion
    waiting = [(list(range(len(strings))), 0)]
    while waiting:
        group, depth = waiting.pop()
        if len(group) == 1 or depth >= shallow:
            leaf(group)
            continue
        pivot = strings[group[len(group) // 2]][depth : depth + 8]
        less, equal, more = [], [], []
        for k in group:
            part = strings[k][depth : depth + 8]
            (less if part < pivot else more if part > pivot else equal).append(k)
        if more:
            waiting.append((more, depth))
        waiting.append((equal, depth + 8 if len(pivot) == 8 else shallow))
        if less:
            waiting.append((less, depth))
    return order, lengths
