"""Cameras and bird's-eye views (R1-R4, R6): small matrices made on the driver, used as literals."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def rotation(yaw: float, pitch: float, roll: float) -> np.ndarray:
    """Rz(yaw) Ry(pitch) Rx(roll)."""
    cy, sy, cp, sp, cr, sr = np.cos(yaw), np.sin(yaw), np.cos(pitch), np.sin(pitch), np.cos(roll), np.sin(roll)
    return np.array([[cy, -sy, 0], [sy, cy, 0], [0, 0, 1]]) @ np.array([[cp, 0, sp], [0, 1, 0], [-sp, 0, cp]]) @ np.array([[1, 0, 0], [0, cr, -sr], [0, sr, cr]])


#: Vehicle axes (x ahead, y left, z up) to camera axes (x right, y down, z ahead).
TO_CAMERA = np.array([[0.0, -1, 0], [0, 0, -1], [1, 0, 0]])


@dataclass(frozen=True)
class Pinhole:
    """A pinhole camera on a vehicle: focal lengths and centre in pixels, position in metres, angles in radians."""

    fx: float
    fy: float
    cx: float
    cy: float
    position: tuple[float, float, float] = (0.0, 0.0, 1.5)
    yaw: float = 0.0
    pitch: float = 0.0
    roll: float = 0.0

    @property
    def intrinsics(self) -> np.ndarray:
        return np.array([[self.fx, 0, self.cx], [0, self.fy, self.cy], [0, 0, 1.0]])

    @property
    def extrinsics(self) -> np.ndarray:
        r = TO_CAMERA @ rotation(self.yaw, self.pitch, self.roll).T
        return np.column_stack([r, -r @ np.array(self.position)])

    @property
    def projection(self) -> np.ndarray:
        return self.intrinsics @ self.extrinsics

    def project(self, points: np.ndarray) -> np.ndarray:
        """World points (n, 3) to pixels (n, 2); behind the camera is NaN."""
        h = np.column_stack([points, np.ones(len(points))]) @ self.projection.T
        ok = h[:, 2] > 0
        return np.where(ok[:, None], h[:, :2] / np.where(ok, h[:, 2], 1)[:, None], np.nan)

    def direction(self, pixels: np.ndarray) -> np.ndarray:
        """Unit directions of pixels in the vehicle's frame."""
        rays = np.column_stack([pixels, np.ones(len(pixels))]) @ np.linalg.inv(self.intrinsics).T @ self.extrinsics[:, :3]
        return rays / np.linalg.norm(rays, axis=1, keepdims=True)


def pinhole_of(cameraData: dict) -> Pinhole:  # noqa: N803 (the name is the preset's)
    """A camera from a preset's intrinsic and extrinsic sections."""
    i, e = cameraData["intrinsic"], cameraData["extrinsic"]
    return Pinhole(*(float(i[k]) for k in ("fx", "fy", "cx", "cy")), tuple(float(e[k]) for k in "xyz"), float(e["yaw"]), float(e["pitch"]), float(e["roll"]))


#: Head axes (z ahead, y left, x down) of a multi-lens head to camera axes.
HEAD_TO_CAMERA = np.array([[0.0, 0, -1], [0, 1, 0], [1, 0, 0]])


@dataclass(frozen=True)
class PanoramicHead(Pinhole):
    """One camera of a multi-lens head that turns with the vehicle (R2).

    ``position`` is the camera's on the head, ``head_position`` the head's on the
    vehicle. ``rotation_zyx`` are Euler angles in radians, x first and z last;
    a frame's own rotation replaces them for the view and the head's position,
    while the camera's place on the head keeps the built-in ones.
    """

    head_position: tuple[float, float, float] = (0.0, 0.0, 0.0)
    rotation_zyx: tuple[float, float, float] = (0.0, 0.0, 0.0)
    built_in_zyx: tuple[float, float, float] | None = None

    def turned(self, rotation_zyx: tuple[float, float, float]) -> PanoramicHead:
        """The camera at a frame's rotation."""
        return replace(self, rotation_zyx=tuple(rotation_zyx), built_in_zyx=self.built_in_zyx or self.rotation_zyx)

    @property
    def extrinsics(self) -> np.ndarray:
        # the head looks up: a quarter turn brings it level with the vehicle
        level = rotation(0, -np.pi / 2, 0)
        view, fixed = ((rotation(a[2], a[1], a[0]) @ level).T for a in (self.rotation_zyx, self.built_in_zyx or self.rotation_zyx))
        shift = -view @ np.array(self.head_position) - fixed @ np.array(self.position)
        return HEAD_TO_CAMERA @ np.column_stack([view, shift])


def head_of(fx: float, fy: float, cx: float, cy: float, bugPosition, cameraPostion, cameraRotation) -> PanoramicHead:  # noqa: N803 (names and spelling are the preset's)
    """A head's camera from a preset's parameters."""
    return PanoramicHead(fx, fy, cx, cy, tuple(cameraPostion), head_position=tuple(bugPosition), rotation_zyx=tuple(cameraRotation))


@dataclass(frozen=True)
class BirdView:
    """A ground window as a raster (R4): ``view`` is (nearest, furthest, -right, +left) in metres, metres a pixel, and (x, y) shear."""

    camera: Pinhole
    view: tuple[float, float, float, float]
    resolution: float
    shear: tuple[float, float] | None = None

    @property
    def size(self) -> tuple[int, int]:
        """(rows, cols), cut to whole pixels."""
        near, far, right, left = self.view
        return int((far - near) / self.resolution), int((left - right) / self.resolution)

    @property
    def world_to_pixel(self) -> np.ndarray:
        """Ground (x, y, 1) to (col, row, 1): rows run towards the vehicle, columns to the right.

        The first and last pixel lie on the window's edges, and the raster begins at 1.
        """
        near, far, right, left = self.view
        rows, cols = self.size
        sx, sy = (cols - 1) / abs(left - right), (rows - 1) / abs(far - near)
        placed = np.array([[0, -sx, sx * left + 1], [-sy, 0, sy * far + 1], [0, 0, 1.0]])
        if self.shear is None:
            return placed
        kx, ky = self.shear
        return np.array([[1, kx, -kx * cols / 2], [ky, 1, -ky * rows / 2], [0, 0, 1.0]]) @ placed

    @property
    def pixel_to_world(self) -> np.ndarray:
        return np.linalg.inv(self.world_to_pixel)

    @property
    def homography(self) -> np.ndarray:
        """(col, row, 1) of the raster to image pixels, for a flat ground."""
        return self.camera.projection[:, [0, 1, 3]] @ self.pixel_to_world

    def image_to_bird(self, pixels: np.ndarray) -> np.ndarray:
        """Image pixels to raster (col, row)."""
        h = np.column_stack([pixels, np.ones(len(pixels))]) @ np.linalg.inv(self.homography).T
        return h[:, :2] / h[:, 2:]

    def bird_to_image(self, pixels: np.ndarray) -> np.ndarray:
        h = np.column_stack([pixels, np.ones(len(pixels))]) @ self.homography.T
        return h[:, :2] / h[:, 2:]

    def coverage(self, width: int, height: int) -> np.ndarray:
        """A 0/1 mask of the raster's pixels that the image shows."""
        rows, cols = self.size
        c, r = np.meshgrid(np.arange(cols), np.arange(rows))
        h = np.stack([c, r, np.ones_like(c)], -1) @ self.homography.T
        with np.errstate(divide="ignore", invalid="ignore"):
            u, v = h[..., 0] / h[..., 2], h[..., 1] / h[..., 2]
        return ((h[..., 2] > 0) & (u >= 0) & (u < width) & (v >= 0) & (v < height)).astype(np.uint8)


def project_columns(camera: Pinhole, x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """World columns to image columns; null behind the camera."""
    p = camera.projection
    dot = lambda k: x * p[k, 0] + y * p[k, 1] + z * p[k, 2] + F.lit(float(p[k, 3]))
    d = F.when(dot(2) > 0, dot(2))
    return dot(0) / d, dot(1) / d


def normalised(value: Column, mean: float, std: float, scale: float = 255.0) -> Column:
    """Input normalisation of an image channel."""
    return (value / scale - mean) / std
