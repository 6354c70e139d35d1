"""Independent SQL for every query, run on a second engine over the same files."""

from tidemark.oracle import bi, mirror, primitives, views


def sql_by_name() -> dict[str, str]:
    return {**views.SQL, **bi.SQL, **mirror.SQL, **primitives.SQL}
