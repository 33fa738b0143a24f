"""A small set of monthly extract files with the known defects."""

from __future__ import annotations

import csv
from pathlib import Path

RATES = "{'Caregiver': 16, 'Med Tech': 21, 'LPN': 31}"

RESIDENTS = [
    "resident_id", "community_id", "first_name", "last_name", "dob", "gender", "admit_date", "discharge_date",
    "care_level", "acuity_score",
]

# resident: community, admit, discharge, level spellings per month, acuity per month
PEOPLE = {
    "R1": ("C001", "2024-06-01", None, ["IL", "Independent", "independent living "], ["3", "3", "6"]),
    "R2": ("C001", "2025-01-10", "2025-02-20", ["AL", "Assisted", "Assisted Living"], ["4", "4", "4"]),
    "R3": ("C002", "2025-02-01", "2026-04-28", ["MC", "Memory", "Memory Care"], ["99", "7", "7"]),
    "R4": ("C002", "2025-03-05", "2025-03-01", ["AL", "AL", "AL"], ["2", "2", "x"]),
    "R5": ("C007", "2025-01-01", None, ["MC", "Respite", "MC"], ["-5", "5", "5"]),
    "R6": ("C007", None, None, ["", "", ""], ["", "1", "1"]),
}


def us(text):
    if not text:
        return ""
    y, m, d = text.split("-")
    return f"{m}/{d}/{y}"


def write(folder: Path, name: str, header: list[str], rows) -> Path:
    path = folder / name
    with path.open("w", newline="") as f:
        out = csv.writer(f, lineterminator="\r\n")
        out.writerow(header)
        out.writerows([["" if v is None else v for v in r] for r in rows])
    return path


def residents(folder: Path, month: int) -> Path:
    rows = []
    for rid, (place, admit, out, levels, scores) in PEOPLE.items():
        if rid == "R6" and month == 3:
            continue  # missing from the last snapshot
        shown = us if month == 2 else (lambda t: t or "")
        row = [rid, place, "First" + rid, "Last" + rid, shown("1940-01-02"), "F", shown(admit), shown(out),
               levels[month - 1], scores[month - 1]]
        if rid == "R1" and month == 2:
            rows.append([rid, "C004", "Frist", *row[3:]])  # strayed identity comes first
        rows.append(row)
    header = list(RESIDENTS)
    if month == 2:  # a column that exists in one month only
        header.append("mobility_status")
        rows = [[*r, "Walker"] for r in rows]
    return write(folder, f"pcc_residents_2025_{month:02d}.csv", header, rows)


def make(folder: Path) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    for month in (1, 2, 3):
        residents(folder, month)
        stamp = f"2025_{month:02d}"
        first = f"2025-{month:02d}-01"
        write(
            folder, f"yardi_units_{stamp}.csv",
            ["unit_id", "community_id", "unit_type", "monthly_rent", "snapshot_date"],
            [[f"U{i}", c, "AL", 4000 + i, first] for i, c in enumerate(["C001", "C001", "C002", "C007"])]
            + [["U900", "C905", "AL", 1, first]],
        )
        write(
            folder, f"adp_shifts_{stamp}.csv",
            ["shift_id", "community_id", "employee_id", "role", "shift_date", "hours_worked", "hourly_rate"],
            [[f"S{month}-{i}", c, f"E{i}", role, first, hours, rate] for i, (c, role, hours, rate) in enumerate([
                ("C001", "Caregiver", 8, RATES), ("C001", "RN", 8, RATES), ("C002", "LPN", 16, RATES),
                ("C002", "LPN", 16.5, RATES), ("C007", "Cook", 8, "18.25"), ("C007", "Cook", 0, "18.25"),
                ("C007", "Cook", 8, "garbage"), ("C007", "Cook", "NA", "12"),
            ])],
        )
        write(
            folder, f"gbp_reviews_{stamp}.csv",
            ["review_id", "community_id", "review_date", "rating", "review_text", "response_text", "responded_at"],
            [
                [f"G{month}-1", "C001", f"2025-{month:02d}-05", 5, "Very\nnice, \"truly\"", "Thanks", f"2025-{month:02d}-08"],
                [f"G{month}-2", "C001", f"2025-{month:02d}-06", 2, "NA", "", ""],
                [f"G{month}-3", "C002", f"2025-{month:02d}-07", 9, "odd", "", ""],
            ],
        )
    write(
        folder, "pcc_incidents_2025_02.csv",
        ["incident_id", "resident_id", "community_id", "incident_date", "incident_type", "severity", "reported_by"],
        [
            ["I1", "R1", "C001", "2025-02-03", "Fall", 4, "E1"], ["I1", "R1", "C001", "2025-02-03", "Fall", 9, "E1"],
            ["I2", "R2", "C001", "2025-02-04", "Fall", 2, "E1"], ["I3", "R5", "C007", "2025-02-05", "Fall", 1, "E2"],
        ],
    )
    write(
        folder, "pcc_care_history_2025_02.csv",
        ["resident_id", "change_date", "previous_level", "new_level", "reason"],
        [["R1", "2025-02-10", "Independent", "Assisted", "Acuity Increase"], ["R5", "2025-01-01", "", "MC", "Admission"]],
    )
    lease_header = ["lease_id", "resident_id", "unit_id", "community_id", "move_in_date", "move_out_date",
                    "move_out_reason", "monthly_rate"]
    write(folder, "yardi_leases_2025_01.csv", lease_header, [
        ["L1", "R1", "U0", "C001", "2024-06-01", "", "", 3100], ["L2", "R2", "U1", "C001", "2025-01-10", "", "", 2800],
        ["L4", "R3", "U2", "C002", "2025-02-09", "2025-02-01", "", 100],
    ])
    write(folder, "yardi_leases_2025_02.csv", lease_header, [
        ["L2", "R2", "U1", "C001", "2025-01-10", "2025-02-20", "Financial", 2800],
    ])
    lead_header = ["lead_id", "community_id", "lead_source", "created_date", "tour_date", "deposit_date",
                   "move_in_date", "status", "lost_reason"]
    write(folder, "hubspot_leads_2025_01.csv", lead_header, [
        ["H1", "C001", "Web", "2025-01-02", "", "", "", "Lost", "Price"],
        ["H2", "C002", "Web", "2025-01-03", "2025-01-09", "2025-01-05", "", "Open", ""],
    ])
    write(folder, "hubspot_leads_2025_03.csv", lead_header, [
        ["H1", "C002", "Web", "2025-01-02", "2025-01-04", "2025-02-01", "2025-01-31", "Won", ""],
    ])
    (folder / "notes.csv").write_text("a\n1\n")
    (folder / "unknown_table_2025_01.csv").write_text("a\n1\n")
    return folder
