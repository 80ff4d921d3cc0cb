"""Settings of the stages as records; from_dict() takes what a config file holds and refuses unknown names."""

from __future__ import annotations

from dataclasses import dataclass, fields


class _Record:
    @classmethod
    def from_dict(cls, values: dict):
        names = {f.name for f in fields(cls)}
        if unknown := sorted(set(values) - names):
            raise ValueError(f"{cls.__name__} has no {', '.join(unknown)}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


@dataclass(frozen=True)
class TrackConfig(_Record):
    """Whose hand is tracked. Falling back on the other hand would mix the sides, so it isn't offered."""

    physical_hand: str = "right"
    max_hands: int = 1
    min_score: float = 0.5
    allow_opposite_hand_fallback: bool = False

    def __post_init__(self):
        if self.physical_hand not in ("left", "right", "auto"):
            raise ValueError("the hand is left, right or auto")
        if self.allow_opposite_hand_fallback:
            raise ValueError("falling back on the opposite hand is forbidden")
        if self.max_hands < 1:
            raise ValueError("one hand at least")


@dataclass(frozen=True)
class AuditConfig(_Record):
    """The rates that a sequence has to reach."""

    min_detection_rate: float = 0.5
    min_class_detection_rate: float = 0.5
    edge_trim: float = 0.2
    exclude_unknown_scenes: bool = True


@dataclass(frozen=True)
class ManifestConfig(_Record):
    """Which recordings make up an experiment, and how subjects are split."""

    sources: tuple[str, ...] = ()
    scenes: tuple[str, ...] = ()
    polarities: tuple[str, ...] = ()
    train_sources: tuple[str, ...] = ()
    test_sources: tuple[str, ...] = ()
    ratios: tuple[float, float, float] = (0.7, 0.15, 0.15)
    seed: int = 0
