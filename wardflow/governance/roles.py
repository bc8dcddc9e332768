"""Roles and what they inherit."""

from __future__ import annotations

from collections.abc import Iterable

ADMIN, ANALYST, CLINICIAN, ACCOUNT_ADMIN = "ADMIN", "ANALYST", "CLINICIAN", "ACCOUNT_ADMIN"

# Fixed values: (granted role, role that receives it).
DEFAULT_GRANTS = (
    (ADMIN, ACCOUNT_ADMIN),
    (ANALYST, ADMIN),
    (CLINICIAN, ADMIN),
)


def role_closure(active: str | Iterable[str], grants: Iterable[tuple[str, str]] = DEFAULT_GRANTS) -> frozenset[str]:
    """The active roles and every role they hold through grants."""
    inherited: dict[str, set[str]] = {}
    for granted, holder in grants:
        inherited.setdefault(holder, set()).add(granted)
    todo = [active] if isinstance(active, str) else list(active)
    held: set[str] = set()
    while todo:
        role = todo.pop()
        if role not in held:
            held.add(role)
            todo.extend(inherited.get(role, ()))
    return frozenset(held)
