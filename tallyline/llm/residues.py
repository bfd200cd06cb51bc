"""Exact integer matrix products in single precision, by residues.

Matrices are taken modulo several small primes, multiplied in float32 where every partial sum is a whole
number that a float32 holds, and put together by Chinese remaindering in mixed radix. Residues lie around
zero, so that signs come out by themselves.
"""

from __future__ import annotations

import numpy as np

TERMS = 64  # products added in single precision at a time
LARGEST = 1024  # residues of a smaller prime are below half of it: TERMS of their products stay below 2^24


def primes_below(limit: int) -> list[int]:
    """The odd primes below ``limit``, largest first."""
    return [n for n in range(limit - 1, 2, -1) if all(n % d for d in range(2, int(n**0.5) + 1))]


PRIMES = primes_below(LARGEST)


def primes_for(bound: int) -> list[int]:
    """As many primes as tell all numbers from ``-bound`` to ``bound`` apart."""
    chosen, span = [], 1
    for prime in PRIMES:
        if span > 2 * bound:
            break
        chosen.append(prime)
        span *= prime
    return chosen


def around_zero(values: np.ndarray, prime: int) -> np.ndarray:
    """Whole numbers in doubles, modulo a prime, none further from zero than half of it."""
    return values - prime * np.rint(values / prime)


def residue_matrix(numbers: np.ndarray, prime: int) -> np.ndarray:
    rest = np.mod(numbers, prime)
    return np.where(rest > prime // 2, rest - prime, rest).astype(np.float32)


def largest(numbers: np.ndarray) -> int:
    return max(int(numbers.max()), -int(numbers.min())) if numbers.size else 0


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of 64-bit integers, exact. A product that 64 bits can't hold is an error."""
    bound = left.shape[1] * largest(left) * largest(right)
    primes = primes_for(bound)
    digits: list[np.ndarray] = []
    for prime in primes:
        a, b = residue_matrix(left, prime), residue_matrix(right, prime)
        total = np.zeros((len(left), len(right)))
        for start in range(0, left.shape[1], TERMS):
            total += a[:, start : start + TERMS] @ b[:, start : start + TERMS].T
        digit = around_zero(total, prime)
        for earlier, known in zip(primes, digits, strict=False):  # the digit in mixed radix
            digit = around_zero((digit - known) * pow(earlier, -1, prime), prime)
        digits.append(digit)
    value, size = np.zeros((len(left), len(right)), np.int64), np.zeros((len(left), len(right)))
    for prime, digit in zip(reversed(primes), reversed(digits), strict=True):
        value = value * prime + digit.astype(np.int64)
        if bound >= 2**63:
            size = size * prime + digit
    if size.size and np.abs(size).max() >= 2.0**63:
        raise OverflowError("a score does not fit into 64 bits")
    return value
