"""The registered queries, one module per operator family."""

from importlib import import_module

FAMILIES = (
    "scans", "projections", "missing", "joins", "aggregates", "windows", "ordering", "sets",
    "scalars", "timeline", "streams", "jobs", "distributions", "learning", "texts",
)


def load() -> None:
    for family in FAMILIES:
        import_module(f"quillframe.catalog.{family}")
