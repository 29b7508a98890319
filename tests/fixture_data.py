"""The hand-written landing cases (FIXTURES.md §2) as JSON-lines files."""

from __future__ import annotations

import json
import os

# Customers: (serialNumber, email, registrationDate, consenting?)
CUSTOMERS = [
    ("s1", "a", 10, True),
    ("s1", "a", 20, True),
    ("s3", "a", 20, True),
    ("s2", "b", 10, False),
    ("s4", "c", 10, True),
]
# Accelerometer: (user, timestamp); x, y, z are whole numbers in the files
ACCEL = [("a", 100), ("a", 100), ("a", 101), ("b", 100), ("c", 100), ("d", 100)]
# Step trainer: (sensorReadingTime, serialNumber, distanceFromObject)
STEPS = [(100, "s1", 5), (100, "s1", 5), (101, "s1", 6), (100, "s2", 7), (100, "s3", 8), (999, "s1", 9)]


def _write(path: str, name: str, lines: list[str]) -> str:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def write_landing(root: str) -> dict[str, str]:
    cust = []
    for serial, email, reg, consent in CUSTOMERS:
        rec = {
            "customerName": f"name-{serial}",
            "email": email,
            "phone": "555",
            "birthDay": "1990-01-01",
            "serialNumber": serial,
            "registrationDate": reg,
            "lastUpdateDate": reg,
            "shareWithPublicAsOfDate": reg,
        }
        if consent:
            rec["shareWithResearchAsOfDate"] = reg
        cust.append(json.dumps(rec))
    accel = [json.dumps({"timestamp": t, "user": u, "x": 1, "y": 2, "z": 3}) for u, t in ACCEL]
    accel.append('{"timestamp": 100, "user": "a", "x": ')  # malformed
    steps = [json.dumps({"sensorReadingTime": t, "serialNumber": s, "distanceFromObject": d}) for t, s, d in STEPS]
    return {
        "customer_landing": os.path.join(_write(f"{root}/customer", "customers.json", cust), "customers.json"),
        "accelerometer_landing": _write(f"{root}/accelerometer", "part-0.json", accel),
        "step_trainer_landing": _write(f"{root}/step_trainer", "part-0.json", steps),
    }
