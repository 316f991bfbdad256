"""Change-event analytics on Spark: routing, images, keys, numbering, monitoring and audit."""

from rowtide.options import VARIANTS, ConvertOptions
from rowtide.plans.convert import convert
from rowtide.session import prepare_session

__all__ = ["ConvertOptions", "VARIANTS", "convert", "prepare_session"]
