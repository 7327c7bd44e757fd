"""Explicit schemas of the raw documents and of the tables built from them."""

from __future__ import annotations

from collections.abc import Mapping

CORRUPT = "_corrupt_record"

Schema = dict[str, str]


def ddl(schema: Mapping[str, str]) -> str:
    """The schema as text that ``from_json`` and the readers accept."""
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


def struct(schema: Mapping[str, str]) -> str:
    return "struct<" + ",".join(f"`{name}`:{kind}" for name, kind in schema.items()) + ">"


def in_order(schema: Schema) -> Schema:
    return {name: schema[name] for name in sorted(schema)}


def _all(kind: str, names: tuple[str, ...]) -> Schema:
    return dict.fromkeys(names, kind)


PEER = "struct<_:string,channel_id:string,user_id:string,chat_id:string>"
MEDIA = (
    "struct<_:string,photo:struct<id:bigint>,document:struct<id:bigint>,video:boolean,"
    "voice:boolean,webpage:struct<id:bigint,url:string,type:string,site_name:string,"
    "title:string,description:string>>"
)
# Before pseudonymisation a web page may hold its cached page, as JSON text.
PRIVATE_MEDIA = MEDIA.replace("description:string", "description:string,cached_page:string")
FORWARD = f"struct<date:timestamp,from_id:{PEER},channel_post:bigint>"
REPLY = f"struct<reply_to_msg_id:bigint,reply_to_peer_id:{PEER},forum_topic:boolean>"
REACTIONS = (
    "struct<results:array<struct<count:bigint,"
    "reaction:struct<emoticon:string,document_id:bigint>>>>"
)
ENTITY = "struct<_:string,offset:int,length:int,url:string>"

_MESSAGE_SCALARS: Schema = {
    "_": "string",
    "id": "bigint",
    "date": "timestamp",
    "message": "string",
    **_all(
        "boolean",
        (
            "mentioned",
            "legacy",
            "out",
            "media_unread",
            "silent",
            "noforwards",
            "post",
            "from_scheduled",
            "edit_hide",
            "pinned",
            "invert_media",
        ),
    ),
    **_all("bigint", ("via_bot_id", "views", "forwards", "comments_msg_id")),
    "edit_date": "timestamp",
}

# A pseudonymised message as stored, one JSON object per line. ``action`` exists on
# service messages only and keeps its JSON text.
RAW_MESSAGE: Schema = {
    **_MESSAGE_SCALARS,
    "from_id": PEER,
    "media": MEDIA,
    "fwd_from": FORWARD,
    "replies": "struct<replies:bigint,comments:boolean>",
    "reply_to": REPLY,
    "reactions": REACTIONS,
    "text_urls": "array<string>",
    "text_mentions": "array<string>",
    "action": "string",
}

# The narrow view used to follow forwards: three fields, any tag.
FORWARD_VIEW: Schema = {"id": "bigint", "fwd_from": FORWARD, "reply_to": REPLY}

# A message before pseudonymisation. Identities are read as text, so that numeric and
# textual ids hash alike.
PRIVATE_MESSAGE: Schema = {
    **_MESSAGE_SCALARS,
    "peer_id": PEER,
    "from_id": PEER,
    "post_author": "string",
    "media": PRIVATE_MEDIA,
    "fwd_from": (
        f"struct<date:timestamp,from_id:{PEER},channel_post:bigint,saved_from_peer:{PEER},"
        "from_name:string,post_author:string>"
    ),
    "replies": (
        f"struct<replies:bigint,comments:boolean,channel_id:string,recent_repliers:array<{PEER}>>"
    ),
    "reply_to": REPLY,
    "reactions": REACTIONS,
    "entities": f"array<{ENTITY}>",
    "action": "string",
}

# The message table: 39 columns besides its keys, in sorted order. The tag is not one.
MESSAGES: Schema = in_order(
    {
        **{name: kind for name, kind in _MESSAGE_SCALARS.items() if name != "_"},
        **_all("array<string>", ("text_urls", "text_mentions")),
        "media_type": "string",
        "media_id": "bigint",
        **_all(
            "string",
            (
                "webpage_preview_url",
                "webpage_preview_type",
                "webpage_preview_site_name",
                "webpage_preview_title",
                "webpage_preview_description",
                "from_type",
                "from_id",
            ),
        ),
        "replies_to_msg_id": "bigint",
        "replies_to_chan_id": "string",
        "fwd_from_date": "timestamp",
        "fwd_from_type": "string",
        "fwd_from_id": "string",
        "fwd_from_msg_id": "bigint",
        "nr_replies": "bigint",
        "has_comments": "boolean",
        "reactions": "map<string,bigint>",
    }
)

# Service messages and comments stored the old way: these are whole messages.
SERVICE_MESSAGES: Schema = {
    "id": "bigint",
    "date": "timestamp",
    "action_type": "string",
    "action": "string",
    **{name: kind for name, kind in MESSAGES.items() if name not in ("id", "date")},
}

# Constructor fields of a user. Nested ones that no operator reads stay JSON text.
USER: Schema = {
    **_all("string", ("_", "id")),
    **_all(
        "boolean",
        (
            "is_self",
            "contact",
            "mutual_contact",
            "deleted",
            "bot",
            "bot_chat_history",
            "bot_nochats",
            "verified",
            "restricted",
            "min",
            "bot_inline_geo",
            "support",
            "scam",
            "apply_min_photo",
            "fake",
            "bot_attach_menu",
            "premium",
            "attach_menu_enabled",
            "bot_can_edit",
            "close_friend",
            "stories_hidden",
            "stories_unavailable",
        ),
    ),
    **_all("bigint", ("access_hash", "bot_info_version", "stories_max_id")),
    **_all(
        "string",
        (
            "first_name",
            "last_name",
            "username",
            "usernames",
            "phone",
            "photo",
            "status",
            "restriction_reason",
            "bot_inline_placeholder",
            "lang_code",
            "emoji_status",
            "color",
            "profile_color",
        ),
    ),
}
# Personal and display-only fields that the user table leaves out (fixed values).
USER_DROPPED = (
    "_",
    "contact",
    "mutual_contact",
    "close_friend",
    "first_name",
    "last_name",
    "username",
    "usernames",
    "phone",
    "restriction_reason",
    "photo",
    "emoji_status",
    "color",
    "profile_color",
    "status",
)
USERS: Schema = {name: kind for name, kind in USER.items() if name not in USER_DROPPED}

# Content types with a counter per channel (fixed values).
CONTENT_TYPES = ("document", "message", "gif", "music", "photo", "url", "video", "voice")
_COUNTS = _all("bigint", tuple(f"{name}_count" for name in CONTENT_TYPES))

# Scalar fields of the two halves of a channel document that pass through unchanged.
_CHAT_PLAIN: Schema = {
    **_all("string", ("username", "title")),
    **_all("bigint", ("access_hash", "level", "stories_max_id")),
    **_all(
        "boolean",
        (
            "creator",
            "left",
            "broadcast",
            "verified",
            "megagroup",
            "restricted",
            "signatures",
            "min",
            "scam",
            "has_link",
            "has_geo",
            "slowmode_enabled",
            "call_active",
            "call_not_empty",
            "fake",
            "gigagroup",
            "noforwards",
            "join_to_send",
            "join_request",
            "forum",
            "stories_unavailable",
        ),
    ),
}
_FULL_PLAIN: Schema = {
    **_all("string", ("about", "linked_chat_id", "migrated_from_chat_id", "theme_emoticon")),
    **_all(
        "bigint",
        (
            "pts",
            "admins_count",
            "kicked_count",
            "banned_count",
            "online_count",
            "read_inbox_max_id",
            "read_outbox_max_id",
            "unread_count",
            "migrated_from_max_id",
            "pinned_msg_id",
            "available_min_id",
            "folder_id",
            "slowmode_seconds",
            "stats_dc",
            "ttl_period",
            "requests_pending",
        ),
    ),
    **_all(
        "boolean",
        (
            "can_view_participants",
            "can_set_username",
            "can_set_stickers",
            "hidden_prehistory",
            "can_set_location",
            "has_scheduled",
            "can_view_stats",
            "blocked",
            "can_delete_channel",
            "antispam",
            "participants_hidden",
            "translations_disabled",
            "stories_pinned_available",
        ),
    ),
}
# Fields that both halves may carry: there the full half wins.
_SHARED: Schema = {"participants_count": "bigint", "stories_hidden": "boolean"}
CHAT_ONLY = tuple(_CHAT_PLAIN)
FULL_ONLY = tuple(_FULL_PLAIN)
SHARED = tuple(_SHARED)

CHAT = struct(
    {
        "id": "string",
        **_CHAT_PLAIN,
        **_SHARED,
        "usernames": "array<struct<username:string,active:boolean>>",
        "date": "string",
        "access_hashes": "map<string,bigint>",
        "photo": "string",
        "migrated_to": "struct<channel_id:string>",
    }
)
FULL_CHAT = struct(
    {
        "id": "string",
        **_FULL_PLAIN,
        **_SHARED,
        "chat_photo": "string",
        "bot_info": "array<struct<user_id:bigint>>",
        "stickerset": "struct<id:bigint>",
        "location": "struct<_:string,geo_point:struct<long:double,lat:double>,address:string>",
    }
)
CHANNEL_DOC: Schema = {
    "chats": f"array<{CHAT}>",
    "full_chat": FULL_CHAT,
    "users": f"array<{struct(USER)}>",
    "participants": f"array<{struct(USER)}>",
    **_all("array<string>", ("recommended_channels", "forwards_from", "recommended_by")),
    **_COUNTS,
    "last_queried_at": "string",
}

CHANNELS: Schema = in_order(
    {
        "id": "string",
        **_CHAT_PLAIN,
        **_FULL_PLAIN,
        **_SHARED,
        "usernames": "array<string>",
        "date": "timestamp",
        "migrated_to": "string",
        "bot_ids": "array<bigint>",
        **_all("array<string>", ("linked_chats_ids", "forwards_from", "recommended_channels")),
        "location_point": "array<double>",
        "location_str": "string",
        "last_queried_at": "timestamp",
        "sticker_set_id": "bigint",
        **_COUNTS,
    }
)

ANON_MAP: Schema = {"original": "string", "hash": "string"}
OBSERVATIONS: Schema = {
    "channel_id": "string",
    "id": "bigint",
    "queried_at": "timestamp",
    "views": "bigint",
    "forwards": "bigint",
    "edit_date": "timestamp",
    "reactions": "map<string,bigint>",
    "replies": "bigint",
}

# Peer tag -> the field that holds its id (fixed values).
PEER_ID_FIELDS = {
    "PeerChannel": "channel_id",
    "PeerUser": "user_id",
    "PeerChat": "chat_id",
}

# Tags of the two record kinds (fixed values).
MESSAGE_TAGS = ("Message", "MessageService")

# Media tags a message may carry; any other is a decoding error (fixed values).
MEDIA_TAGS = (
    "MessageMediaPhoto",
    "MessageMediaDocument",
    "MessageMediaWebPage",
    "MessageMediaGeo",
    "MessageMediaContact",
    "MessageMediaUnsupported",
    "MessageMediaVenue",
    "MessageMediaGame",
    "MessageMediaInvoice",
    "MessageMediaGeoLive",
    "MessageMediaPoll",
    "MessageMediaDice",
    "MessageMediaStory",
    "MessageMediaGiveaway",
    "MessageMediaGiveawayResults",
)
