from quayside.functions.paths import (
    landing_path,
    path_after,
    path_piece,
    size_mb,
    strip_extension,
)

__all__ = ["landing_path", "path_after", "path_piece", "size_mb", "strip_extension"]
