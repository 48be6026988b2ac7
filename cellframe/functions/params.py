"""Parameter strings and the checks shared by stages."""

from __future__ import annotations

Radius = float | tuple[float, float] | None


def parse_equality(text: str) -> tuple[str, str]:
    """``"column==value"`` -> (column, value), split at the first ``==``."""
    column, sep, value = text.partition("==")
    if not sep:
        raise ValueError(f"cell filter needs '==', got {text!r}")
    return column.strip(), value.strip()


def parse_radius(text: str | None) -> Radius:
    """``"100"`` -> 100.0, ``"50,200"`` -> (50.0, 200.0), blank -> None."""
    if text is None or not text.strip():
        return None
    if "," not in text:
        return float(text)
    bounds = [float(p) for p in text.split(",") if p.strip()]
    if len(bounds) != 2:
        raise ValueError("radius is a number or 'min,max'")
    low, high = bounds
    if low > high:
        raise ValueError("radius interval needs min <= max")
    return low, high


def parse_transform(name: str | None) -> str | None:
    if name in (None, "none"):
        return None
    if name not in ("spectral", "cosine"):
        raise ValueError(f"unknown adjacency transform {name!r}")
    return name


def parse_resolutions(text: str) -> list[float]:
    out = []
    for item in text.split(","):
        try:
            out.append(float(item))
        except ValueError:
            raise ValueError(f"invalid resolution value {item!r}") from None
    return out


def resolution_column(resolution: float) -> str:
    """0.5 -> ``leiden_res0p5``."""
    return "leiden_res" + str(resolution).replace(".", "p")


def resolution_of(column: str) -> float | None:
    """``leiden_res0p5`` -> 0.5; None when the name carries no resolution."""
    if not column.startswith("leiden_res"):
        return None
    try:
        return float(column.removeprefix("leiden_res").replace("p", "."))
    except ValueError:
        return None


def annotation_column(cluster_key: str, given: str | None = None) -> str:
    """Name of the label column that belongs to a cluster column."""
    if given:
        return given
    if cluster_key.startswith("leiden_res"):
        return "cell_type_res" + cluster_key.removeprefix("leiden_res")
    return f"cell_type_{cluster_key}"


def output_target(source: str, output: str | None, inplace: bool) -> str:
    """Exactly one of ``output`` and ``inplace``."""
    if bool(output) == bool(inplace):
        raise ValueError("give exactly one of output and inplace")
    return source if inplace else output


def check_cluster_range(low: int, high: int, forced: int | None = None) -> None:
    if low < 2:
        raise ValueError("min_clusters must be >= 2")
    if high < low:
        raise ValueError("max_clusters must be >= min_clusters")
    if forced is not None and not low <= forced <= high:
        raise ValueError("force_n_clusters must lie within [min_clusters, max_clusters]")
