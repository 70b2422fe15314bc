"""What the operators use of the library's staging."""

from corpusloom.sources.staging import bucketed, materialize, new_path, release, scratch, ship_package, shared_root

__all__ = ["bucketed", "materialize", "new_path", "release", "scratch", "ship_package", "shared_root"]
