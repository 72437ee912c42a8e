"""Shapes of the landed data.  Fixed values: names as the feeds deliver them."""

from __future__ import annotations

EXTRACTED_AT = "_airbyte_extracted_at"
RAW_ID = "_airbyte_raw_id"

SPACE = "struct<type:string,id:string,name:string,slug:string>"
INITIATOR = (
    "struct<type:string,id:string,name:string,email:string,is_admin:string,"
    "last_name:string,first_name:string,public_uid:string,is_moderator:string>"
)
COMMENT = (
    "struct<type:string,id:string,post_id:string,parent_comment_id:string,"
    "community_member_id:string,record_owner_is_admin:string>"
)
POST = (
    "struct<type:string,id:string,name:string,slug:string,status:string,space_id:string,"
    "published_at:string,community_member_id:string,record_owner_is_admin:string>"
)
LESSON = "struct<id:string,type:string>"

# Leaves are text because numbers and flags may arrive quoted; cleaning casts them.
PAYLOAD = f"struct<space:{SPACE},initiator:{INITIATOR},comment:{COMMENT},posts_basic:{POST},lesson:{LESSON}>"
ENVELOPE = (
    f"id string, name string, version string, payload {PAYLOAD}, created_at string, triggered_at string, "
    f"{EXTRACTED_AT} timestamp, {RAW_ID} string"
)

# Event name of each feed.
FEEDS = {
    "post_comment_created": "post.comment.created",
    "post_liked": "post.liked",
    "post_comment_liked": "post.comment.liked",
    "course_completed": "courses.completed",
    "course_lesson_completed": "courses.lesson.completed",
}

EVENT_FLAGS = [
    "rsvp_disabled",
    "hide_attendees",
    "hide_meta_info",
    "hide_location_from_non_attendees",
    "send_email_reminder",
    "send_email_confirmation",
    "send_in_app_notification_reminder",
    "send_in_app_notification_confirmation",
    "enable_custom_thank_you_message",
]
EVENTS_LIST = (
    "id bigint, url string, body string, host string, name string, slug string, ends_at string, starts_at string, "
    "created_at string, updated_at string, member_name string, member_email string, location_type string, "
    "cover_image_url string, member_avatar_url string, zapier_display_title string, "
    "space struct<id:bigint,name:string,slug:string,community_id:bigint>, topics array<bigint>, "
    "user_id bigint, likes_count bigint, comments_count bigint, community_member_id bigint, "
    "duration_in_seconds bigint, " + ", ".join(f"{f} boolean" for f in EVENT_FLAGS)
)
EVENT_ATTENDEES = (
    "id bigint, event_id bigint, contact_id bigint, community_member_id bigint, headline string, rsvp_date string, "
    "event_name string, member_name string, rsvp_status string, contact_type string, member_email string, "
    "member_avatar_url string"
)
RECORD_SHAPES = {"events_list": EVENTS_LIST, "event_attendees": EVENT_ATTENDEES}
LOAD_COLUMNS = f"{EXTRACTED_AT} timestamp, {RAW_ID} string"

# Tag lists and display places are kept as JSON text, whether they arrive as text or nested.
COMMUNITY_MEMBERS = (
    "community_member_id bigint, first_name string, last_name string, name string, email string, "
    "posts_count bigint, comments_count bigint, created_at string, member_tags string"
)
MEMBER_TAGS_LIST = (
    "id bigint, name string, color string, emoji string, is_public boolean, display_format string, "
    "display_locations string, tagged_members_count bigint, created_at string, updated_at string"
)
#: Tables that each delivery holds as a whole.
SNAPSHOTS = {"community_members": COMMUNITY_MEMBERS, "member_tags_list": MEMBER_TAGS_LIST}

MANAGER_ROSTER = (
    "uid string, id string, first_name string, last_name string, email string, join_date string, tags string, "
    "profile_url string, member__y_n_ string, invitation_status string, invitation_date string"
)

DELIVERY_LOG = (
    "delivery_id string, manager_email string, manager_full_name string, business_name string, report_type string, "
    "week_start_date date, sent_at timestamp, delivery_status string, make_scenario_id string, make_execution_id string"
)
REPORT_TYPES = ["weekly", "monthly"]
DELIVERY_STATUSES = ["sent", "failed", "bounced"]
