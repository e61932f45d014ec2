"""Keys of the derived tables."""

from __future__ import annotations

# Keys that identify a row of each derived table; serving copies are collapsed on the same keys.
TABLE_KEYS = {
    "user_video_relation": ("user_id", "video_id"),
    "user_video_metrics": ("user_id",),
    "video_statistics": ("video_id",),
    "video_statistics_normalized": ("video_id",),
    "global_popular_videos": ("video_id",),
    "local_popular_videos": ("video_id", "region"),
    "region_popular_videos": ("video_id", "region"),
    "follower_graph": ("follower_id", "following_id"),
    "video_upload_stats": ("timestamp", "video_id"),
    "bot_uploaded_content": ("video_id", "timestamp"),
    "ai_ugc": ("video_id",),
    "video_reports": ("video_id", "reporter_user_id", "report_timestamp"),
    "excluded_videos": ("video_id", "exclusion_reason"),
    "user_base_facts": ("user_id",),
    "daily_event_counts": ("event_date", "event_name"),
    "video_index": ("uri",),
}
