from weblens.functions.classify import keyword_level, level_status, severity, status_level
from weblens.functions.clocks import instant, wall_clock
from weblens.functions.line_formats import FORMATS, LineFormat

__all__ = [
    "FORMATS",
    "LineFormat",
    "instant",
    "keyword_level",
    "level_status",
    "severity",
    "status_level",
    "wall_clock",
]
