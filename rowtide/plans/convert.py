"""The conversion job: envelopes in source order to keyed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators import records as R
from rowtide.operators.ordering import drop_repeats, number_envelopes, with_chunks
from rowtide.operators.routing import Routes, dml_only, has_topic, route, with_route
from rowtide.options import ConvertOptions
from rowtide.session import prepare_session


#: What ``number_envelopes`` adds; null where the options ask for no numbers.
NUMBERS = ("out_batch_id", "out_in_id", "first_mid")


def routed_envelopes(
    envelopes: DataFrame,
    routes: Routes,
    options: ConvertOptions = ConvertOptions(),
    starts: DataFrame | None = None,
) -> DataFrame:
    """Kept and routed envelopes. Repeats go first: unrouted envelopes move the sequence too."""
    prepare_session(envelopes.sparkSession)
    kept = with_chunks(envelopes, options.widths)
    if options.drop_repeats:
        kept = drop_repeats(kept, starts, options.widths)
    return route(kept, routes, options.default_topic)


def rows_with_images(routed: DataFrame, options: ConvertOptions = ConvertOptions()) -> DataFrame:
    """One row per changed row of the DML envelopes, with images and key."""
    rows = R.expand_rows(dml_only(routed))
    if options.drop_sensitive:
        rows = R.drop_sensitive(rows)
    return R.add_images(rows, options)


def convert(
    envelopes: DataFrame,
    routes: Routes,
    ts: Column | int,
    options: ConvertOptions = ConvertOptions(),
    starts: DataFrame | None = None,
) -> DataFrame:
    """Envelopes to records with topic and key.

    ``ts`` is the record time, a parameter rather than the clock so that a rerun gives the same
    records. ``starts`` holds one row per source partition with the values at the checkpoint. With
    'quarantine' the rows without a key stay, with a null key; see ``records.with_key``.

    The result is that of repeat filter, routing, DML filter, expansion, images, numbering and
    projection in this order. Topics and images are looked up and built first, as they depend on
    the envelope alone; what counts for the order, the repeat filter before the routing, is kept.
    """
    numbered = numbered_images(envelopes, routes, options, starts)
    return records_of(numbered, ts, options)


def numbered_images(
    envelopes: DataFrame,
    routes: Routes,
    options: ConvertOptions = ConvertOptions(),
    starts: DataFrame | None = None,
) -> DataFrame:
    """Kept, routed and numbered envelopes with the images of their rows."""
    prepare_session(envelopes.sparkSession)
    chunked = with_chunks(envelopes, options.widths)
    folded = R.fold_images(with_route(chunked, routes, options.default_topic), options)
    if options.drop_repeats:
        folded = drop_repeats(folded, starts, options.widths)
    if not options.numbers:
        return has_topic(folded).withColumns({name: F.lit(None).cast("bigint") for name in NUMBERS})
    return number_envelopes(has_topic(folded), starts, options.widths)


def records_of(
    numbered: DataFrame, ts: Column | int, options: ConvertOptions = ConvertOptions()
) -> DataFrame:
    """Records of ``numbered_images``."""
    ts = ts if isinstance(ts, Column) else F.lit(ts)
    rows = R.unfold_images(numbered)
    return R.to_records(R.resolve_missing_key(rows, options.on_missing_key, ts), ts)
