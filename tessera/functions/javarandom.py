"""The JDK's 48-bit linear congruential generator (published in its API docs).

Only used to reproduce start weights from a seed; a few numbers, never data.
"""

from __future__ import annotations

# The generator's multiplier, increment and modulus mask.
_MULT = 0x5DEECE66D
_ADD = 0xB
_MASK = (1 << 48) - 1


class JavaRandom:
    def __init__(self, seed: int):
        self._seed = (seed ^ _MULT) & _MASK

    def _next(self, bits: int) -> int:
        self._seed = (self._seed * _MULT + _ADD) & _MASK
        return self._seed >> (48 - bits)

    def next_double(self) -> float:
        return ((self._next(26) << 27) + self._next(27)) * (1.0 / (1 << 53))


def start_weights(d: int, seed: int = 42) -> list[float]:
    """``d`` values ``2u - 1`` with u uniform from the generator."""
    r = JavaRandom(seed)
    return [2 * r.next_double() - 1 for _ in range(d)]
