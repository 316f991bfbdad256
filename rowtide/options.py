"""Options of the envelope-to-record conversion and the presets of its historical forms."""

from __future__ import annotations

from dataclasses import dataclass, replace

# At most 65k envelopes of one source partition are ordered together. A further width, such as
# (65_536, 1_024), folds the chunk rows once more, for source partitions of over 10^11 envelopes.
DEFAULT_WIDTHS = (65_536,)


@dataclass(frozen=True)
class ConvertOptions:
    """How envelopes become records.

    ``update_image``    'changed': after columns that changed or belong to a key; 'full': all of
                        them; 'none': the map stays null.
    ``null_mode``       'keep': a NULL cell is a null map value; 'empty': it is ``''``.
    ``drop_sensitive``  whether sensitive columns are removed from images and key.
    ``on_missing_key``  'fail', 'batch_time' (the text of ``ts``) or 'quarantine'.
    ``drop_repeats``    whether repeats and regressions are dropped first.
    ``default_topic``   topic of every envelope while the route table is empty.
    ``numbers``         whether batch numbers and record ids are made; audits that read none spare
                        a scan of the log and the shuffle of its counters.
    ``widths``          chunk widths of the ordered steps, see ``operators.ordering``.
    """

    update_image: str = "changed"
    null_mode: str = "keep"
    drop_sensitive: bool = True
    on_missing_key: str = "fail"
    drop_repeats: bool = True
    default_topic: str | None = None
    numbers: bool = True
    widths: tuple[int, ...] = DEFAULT_WIDTHS

    def __post_init__(self) -> None:
        _one_of("update_image", self.update_image, ("changed", "full", "none"))
        _one_of("null_mode", self.null_mode, ("keep", "empty"))
        _one_of("on_missing_key", self.on_missing_key, ("fail", "batch_time", "quarantine"))

    def but(self, **changes) -> "ConvertOptions":
        return replace(self, **changes)


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


# The conversion exists in several ages; these presets give the data semantics of each.
VARIANTS = {
    "current": ConvertOptions(),
    "full_image": ConvertOptions(update_image="full", drop_sensitive=False),
    "local": ConvertOptions(
        update_image="full", null_mode="empty", drop_sensitive=False, on_missing_key="batch_time"
    ),
    "local_unfiltered": ConvertOptions(
        update_image="full",
        null_mode="empty",
        drop_sensitive=False,
        on_missing_key="batch_time",
        drop_repeats=False,
    ),
}
