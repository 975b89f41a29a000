"""What a machine needs for the extraction steps, and what of it is there."""

from __future__ import annotations

import os
from importlib.util import find_spec
from pathlib import Path
from shutil import which

from talkloom.plans.config import Config

#: Packages and programs by what needs them.
NEEDS = {
    "speech": (("faster_whisper",), ("ffmpeg",)),
    "speech by the command line": ((), ("whisper-cli", "ffmpeg")),
    "scenes": (("cv2", "scenedetect"), ()),
    "text in images": (("rapidocr_onnxruntime", "onnxruntime"), ()),
    "speakers": (("pyannote.audio", "torch"), ()),
}


def _package(name: str) -> bool:
    try:
        return find_spec(name) is not None
    except ModuleNotFoundError:
        return False


def device(wanted: str = "auto") -> str:
    """The device that speech recognition would run on: what is asked for, else a GPU if there is one, else the CPU."""
    if wanted != "auto":
        return wanted
    if which("nvidia-smi") or Path("/proc/driver/nvidia").exists():
        return "cuda"
    return "rocm" if Path("/dev/kfd").exists() else "cpu"


def backend(wanted: str = "auto") -> str:
    """The recogniser for a device: the batched one on CPU and CUDA, the command-line one elsewhere."""
    return "cli" if device(wanted) == "rocm" else "batched"


def checks(config: Config) -> dict[str, dict[str, bool]]:
    """For each step what it needs and whether this machine has it."""
    out = {step: {p: _package(p) for p in packages} | {b: which(b) is not None for b in programs} for step, (packages, programs) in NEEDS.items()}
    if config.extract.diarize:
        out["speakers"]["HF_TOKEN"] = bool(os.environ.get("HF_TOKEN"))
    if config.extract.vlm_model:
        out["image description"] = {"OPENAI_BASE_URL": bool(os.environ.get("OPENAI_BASE_URL"))}
    return out


def missing(config: Config, has_media: bool = True) -> list[str]:
    """What stands in the way, as sentences; steps that are turned off need nothing, and without media none does."""
    if not has_media:
        return []
    used = {"speech by the command line" if backend(config.extract.device) == "cli" else "speech", "scenes", "text in images"}
    used |= {"speakers"} if config.extract.diarize else set()
    used |= {"image description"} if config.extract.vlm_model else set()
    return [f"{step} needs {name}" for step, needs in checks(config).items() if step in used for name, there in needs.items() if not there]
