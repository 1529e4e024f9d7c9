"""Constants of a region build in one place; every operator takes its own as a parameter."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # fixed values: defaults of the published build, in metres unless the name says otherwise
    obstacle_buffer: float = 5.0
    adopt_tolerance: float = 50.0
    mesh_edge: float = 650.0
    mesh_points: int = 20_000
    mesh_triangles: int = 200_000
    deep_margin: float = 20.0
    deep_closing: float = 50.0
    drying_share: float = 0.5
    deep_hole: float = 3.0
    mesh_simplify: float = 5.0
    tile_extent: float = 10_000.0
    tile_points: int = 1_500
    crossing_apart: float = 50.0
    crossing_snap: float = 1.0
    crossings_per_line: int = 8
    crossing_connector: float = 250.0
    crossing_fallback: float = 500.0
    depth_ceiling: float = 6.0
    mesh_radius: float = 800.0
    pixel_floor: float = 2.0
    pixel_ceiling: float = 10.0
    pixel_divisor: float = 200.0
    shortest_spur: float = 60.0
    longest_segment: float = 100.0
    deep_enough: float = 5.0
    stitch_radius: float = 500.0
    stitch_nearest: int = 6
    cross_links: int = 2
    inland_radius: float = 300.0
    search_box_degrees: float = 0.015
    seam_band: float = 300.0
    seam_radius: float = 500.0
    seam_links: int = 2
    publish_apart: float = 25.0
    poi_radius: float = 500.0
    poi_snap: float = 120.0
    skipped_bands: tuple[int, ...] = (1, 2)
    source_tier: int = 1
    schema_version: int = 2
