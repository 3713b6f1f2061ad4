"""Sequential models that the distributed operators are checked against."""


def keep_changed(samples):
    """samples: dicts in order; returns the kept ones."""
    base, kept = {}, []
    for s in samples:
        key = (s["session_id"], s["device_id"])
        b = base.get(key)
        if b is None:
            emit = True
        else:
            power = abs(s["power_mw"] - b["power_mw"]) * 100
            if b["power_mw"] == 0:
                percent = 100 if s["power_mw"] else 0
            else:
                percent = int(power / b["power_mw"])
            emit = (
                s["ts_ms"] - b["ts_ms"] > 60_000
                or abs(s["temp_c"] - b["temp_c"]) > 1
                or percent > 10
                or any(s[c] != b[c] for c in ("gpu_util", "mem_util", "used_mib", "clock_sm"))
            )
        if emit:
            kept.append(s)
            base[key] = s
    return kept


def pack(sizes, max_lines, max_bytes):
    """Request number of each line of one window."""
    out, number, lines, size = [], 0, 0, 0
    for s in sizes:
        out.append(number)
        lines, size = lines + 1, size + s
        if lines >= max_lines or size >= max_bytes:
            number, lines, size = number + 1, 0, 0
    return out
