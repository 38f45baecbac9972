"""Small source files: nine users, four mentors, fifteen sessions of which two never end."""

import json
from datetime import datetime, timedelta

USERS = [
    (101, 7, "2023-05-11", "trial"), (102, 7, "2023-05-30", "active"),
    (103, 8, "2023-06-02", "active"), (104, 9, "2023-06-02", "paused"),
    (101, 7, "2023-05-11", "trial"), (105, 9, "2023-07-19", "active"),
    (106, 8, "2023-08-08", "active"), (107, 9, "2023-09-27", "paused"),
    (108, 7, "2023-11-01", "active"), (109, 8, "2023-12-24", "active"),
]
MENTORS = [("K7", "Gold", 150), ("K8", "Silver", 90), ("K4", "Silver", 85), ("K9", "Bronze", 60)]
# user, mentor, first session, days from it to the next ones
SESSIONS = [
    (101, "K7", "2025-04-01", [10]), ("102", "K7", "2025-04-02", []),
    (103, "K7", "2025-04-03", [78]), (104, "K8", "2025-04-05", [20]),
    (105, "K8", "2025-04-06", []), (106, "K4", "2025-05-01", [8, 29]),
    (107, "K9", "2025-05-02", []), (108, "K9", "2025-05-03", [73]),
    (109, "K8", "2025-05-04", []),
]
NEVER_END = {107, 109}


def events():
    out = []

    def add(user, mentor, when, kind):
        out.append({"event_id": f"e{len(out) + 1:02d}", "user_id": user, "mentor_id": mentor,
                    "timestamp": when.strftime("%Y-%m-%dT%H:%M:%SZ"), "event_type": kind})

    for user, mentor, first, later in SESSIONS:
        for day in [0, *later]:
            start = datetime.fromisoformat(first) + timedelta(days=day, hours=16, minutes=15)
            add(user, mentor, start, "session_started")
            if user not in NEVER_END:
                add(user, mentor, start + timedelta(minutes=45), "session_ended")
    return out


def write_csv(path, header, rows):
    text = "\n".join(",".join("" if v is None else str(v) for v in r) for r in [header, *rows])
    path.write_text(text + "\n")
    return str(path)


def write_json(path, records):
    path.write_text("[\n" + ",\n".join("  " + json.dumps(r) for r in records) + "\n]\n")
    return str(path)


def write_all(folder, log=None):
    return {
        "users": write_csv(folder / "users.csv",
                           ["user_id", "company_id", "signup_date", "status"], USERS),
        "mentors": write_csv(folder / "mentors.csv", ["mentor_id", "tier", "hourly_rate"],
                             MENTORS),
        "events": write_json(folder / "events.json", events() if log is None else log),
    }
