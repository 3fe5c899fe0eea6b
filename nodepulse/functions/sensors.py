"""Names of the node sensors, by family, and other values fixed by the data."""

from __future__ import annotations

# How many parts of each kind a node has, and how they are numbered.
SOCKETS = (0, 1)
GPUS_PER_SOCKET = (0, 1, 2)
GPUS = (0, 1, 2, 3, 4, 5)
DIMMS = tuple(range(16))
# Core 13 does not report.
CPU_CORES = tuple(core for core in range(24) if core != 13)
REGULATORS = ("vcs", "vdd", "vddr", "vdn")

GPU_POWERS = [f"p{s}_gpu{g}_power" for s in SOCKETS for g in GPUS_PER_SOCKET]
CPU_POWERS = [f"p{s}_power" for s in SOCKETS]
IO_POWERS = [f"p{s}_io_power" for s in SOCKETS]
MEM_POWERS = [f"p{s}_mem_power" for s in SOCKETS]
NODE_POWERS = ["total_power", "io_power", "fan_disk_power"] + IO_POWERS + MEM_POWERS
SUPPLY_POWERS = [f"ps{s}_input_power" for s in SOCKETS]
SUPPLY_FLOATS = [f"ps{s}_{what}" for s in SOCKETS for what in ("input_voltage", "output_current", "output_voltage")]
GPU_CORE_TEMPS = [f"gpu{g}_core_temp" for g in GPUS]
GPU_MEM_TEMPS = [f"gpu{g}_mem_temp" for g in GPUS]
DIMM_TEMPS = [f"dimm{d}_temp" for d in DIMMS]
CPU_CORE_TEMPS_BY_SOCKET = {s: [f"p{s}_core{c}_temp" for c in CPU_CORES] for s in SOCKETS}
CPU_CORE_TEMPS = CPU_CORE_TEMPS_BY_SOCKET[0] + CPU_CORE_TEMPS_BY_SOCKET[1]
REGULATOR_TEMPS = [f"p{s}_{r}_temp" for s in SOCKETS for r in REGULATORS]
OTHER_TEMPS = ["ambient", "pcie"]

#: Sensors stored as 16-bit watts, as 8-bit degrees and as 32-bit floats.
WATT_SENSORS = GPU_POWERS + CPU_POWERS + NODE_POWERS + SUPPLY_POWERS
DEGREE_SENSORS = GPU_CORE_TEMPS + GPU_MEM_TEMPS + DIMM_TEMPS + CPU_CORE_TEMPS + REGULATOR_TEMPS + OTHER_TEMPS
FLOAT_SENSORS = SUPPLY_FLOATS

#: Row sums and row maxima added when raw readings are loaded.
NODE_SUMS = {
    "gpu_total_power": GPU_POWERS,
    "cpu_total_power": CPU_POWERS,
    "cpu_io_power": IO_POWERS,
    "mem_power": MEM_POWERS,
    "input_power": SUPPLY_POWERS,
}
NODE_MAXIMA = {
    "gpu_core_max_temp": GPU_CORE_TEMPS,
    "gpu_mem_max_temp": GPU_MEM_TEMPS,
    "dimm_max_temp": DIMM_TEMPS,
    "p0_max_temp": CPU_CORE_TEMPS_BY_SOCKET[0],
    "p1_max_temp": CPU_CORE_TEMPS_BY_SOCKET[1],
}

#: Component types compared with each other in the thermal summaries.
COMPONENT_TYPES = {
    "gpu_core": GPU_CORE_TEMPS,
    "gpu_mem": GPU_MEM_TEMPS,
    "dimm": DIMM_TEMPS,
    "cpu_core": CPU_CORE_TEMPS,
}

# GPU error codes and what they stand for.
XID_NAMES = {
    12: "Driver error handling exception",
    13: "Graphics engine exception",
    31: "Memory page fault",
    32: "Corrupted push buffer stream",
    38: "Driver firmware error",
    43: "Stopped processing",
    44: "Graphics engine fault",
    45: "Preemptive cleanup",
    48: "Double-bit error",
    61: "Internal microcontroller warning",
    62: "Internal microcontroller halt",
    63: "Page retirement event",
    64: "Page retirement failure",
    69: "Graphics engine class error",
    74: "NVLINK error",
    79: "Fallen off the bus",
}
HARDWARE_XIDS = (48, 62, 63, 64, 74, 79)
NVLINK_XID = 74
OUTLIER_HOST = "f26n07"
LOGIN_PREFIXES = ("login", "batch")

# PCI addresses of the six GPUs of a node, in slot order.
GPU_PCI_ADDRESSES = (
    "0004:04:00",
    "0004:05:00",
    "0004:06:00",
    "0035:03:00",
    "0035:04:00",
    "0035:05:00",
)

# Limits of the scheduler's size classes and their names.
NODE_CUTS = (45, 91, 921, 2764)
NODE_CLASS_NAMES = ("A-45", "B-91", "C-921", "D-2764", "E-4608")
JOB_TYPES = ("small", "small", "small", "large", "flagship")
FULL_MACHINE_NODES = 4608

# Temperature limits between the five bands.
BAND_CUTS = (80, 83, 87, 90)
CLUSTER_BAND_RANGE = (0, 150)
JOB_BAND_RANGE = (None, None)
HOT_FROM = 83


def mean_of(sensors: list[str]) -> list[str]:
    """Names of the mean columns that the aggregates carry for ``sensors``."""
    return [f"{s}_mean" for s in sensors]
