"""Checks of who is who before an external sample is annotated."""

from __future__ import annotations


def check_identities(selected: list[str], external: list[str], clones: dict[str, str] | None = None) -> str:
    """external names must not be selected ones. With clone ids for all of them, those must be new too.

    Returns 'explicit_clone_metadata' or 'header_names_only'.
    """
    if shared := set(selected) & set(external):
        raise ValueError(f"external samples took part in the selection: {sorted(shared)}")
    if clones is None:
        return "header_names_only"
    if extra := set(clones) - set(selected) - set(external):
        raise ValueError(f"clone ids of unknown samples: {sorted(extra)}")
    if missing := set(external) - set(clones):
        raise ValueError(f"clone ids missing: {sorted(missing)}")
    if shared := {clones[s] for s in selected if s in clones} & {clones[e] for e in external}:
        raise ValueError(f"clones took part in the selection: {sorted(shared)}")
    return "explicit_clone_metadata"


def evidence_context(role: str, status: str) -> tuple[bool, str]:
    """(took part in the selection, what its annotations are evidence of)."""
    if role == "illumina":
        return True, "selection_reuse"
    return False, "external_application_metadata_checked" if status == "explicit_clone_metadata" else "external_application_identity_unverified"


def group_plan(groups: dict[str, list[str]], known: dict[str, str], fraction: str) -> list[dict]:
    """Members of each group in order, one role a group, and the exact support it needs of its configured size."""
    from fractions import Fraction

    share, out = Fraction(fraction), []
    for name, members in sorted(groups.items()):
        if unknown := set(members) - set(known):
            raise ValueError(f"group {name} has unknown samples: {sorted(unknown)}")
        roles = {known[m] for m in members}
        if len(roles) != 1 or len(set(members)) != len(members) or not members:
            raise ValueError(f"group {name} needs distinct members of one role")
        out.append({"group_id": name, "role": roles.pop(), "members": list(members), "n": len(members), "required_support": -(-share.numerator * len(members) // share.denominator)})
    return out
