"""Controlled vocabularies and ordered pattern lists of the record schema."""

# Fixed values of the record format: accepted words, and patterns whose first match decides.
COMPONENT_TYPES = ("3d_printed", "machined", "laser_cut", "electronic", "fastener", "mechanical", "consumable", "misc")
COMPONENT_CATEGORIES = ("mechanical", "electrical", "structural", "control", "interface", "power", "mounting", "safety")
PHASES = ("fabrication", "assembly", "wiring", "bring_up", "testing")
FASTENER_HINTS = ("screw", "nut", "bolt", "washer", "standoff", "spacer", "rivet")
RAW_TYPES = {
    "3d_printed": "3d_printed", "misc": "misc", "actuator": "electronic", "mechanism": "mechanical", "module": "electronic", "power": "electronic",
    "structural": "mechanical", "sensor": "electronic", "mcu": "electronic", "display": "electronic", "enclosure": "mechanical", "other": "misc",
}
ROLES = (
    ("mcu|controller|esp32|raspberry|stm32|arduino|teensy", "main_controller"),
    ("battery|lipo|li[-_ ]?ion|18650", "power_source"),
    ("regulator|buck|boost|converter|psu", "power_conditioning"),
    ("charger|tp4056|bms", "charging"),
    ("display|screen|lcd|oled|matrix", "display"),
    ("button|switch|encoder|keypad|input", "user_input"),
    ("sensor|imu|gyro|accelerometer|bme|tof|lidar", "sensing"),
    ("motor|servo|actuator|solenoid", "actuation"),
    ("speaker|buzzer|piezo|amp", "audio_output"),
    ("antenna|rf|radio|lora|wifi|bluetooth", "wireless"),
    ("mount|bracket|holder|standoff", "mounting"),
    ("enclosure|case|housing|cover|panel|body", "enclosure"),
    ("screw|nut|bolt|washer", "fastener"),
    ("frame|chassis|rail|beam|spar", "structural"),
    ("bearing|axle|shaft|coupler", "kinematic"),
)
RELATIONS = (
    (r"servo[_ ]?horn|rotational[_ ]joint|pivot|axle|bearing|rotate|shaft\b", "rotates_on"),
    (r"wrap(?:ped)?[_ ]around|pulley|belt[_ ]around|cable[_ ]around|routed|guide[_ ]for", "routed_around"),
    (r"hous(?:ed|ing)|enclos|contain|hold[s]?[_ ]in[_ ]place|integrate|placed[_ ]inside", "contains"),
    (r"barb|hose[_ ]clamp|press[_ ]?fit|thread|screw[_ ]into|fasten[_ ]into|t[-_ ]nut|\bM\d.{0,40}\b(?:screws?|bolts?|nuts?|hardware)\b", "fastens_into"),
    ("connect|wire|cable|signal|harness", "connects_to"),
    ("support|backed[_ ]by|rests[_ ]on|sits[_ ]on", "supported_by"),
    ("position|locate|align", "positions"),
    (r"^secur|^screws?\b|^bolts?\b|^nuts?\b|fastened|secures", "secured_by"),
    ("mount", "mounted_on"),
    ("attach|fit|snap|clip|glue|adhesive", "attached_to"),
)
STOPWORDS = (
    "a", "an", "the", "with", "and", "for", "of", "to", "in", "on", "via", "system", "module", "controller", "kit", "device", "unit", "mini",
    "small", "portable", "desktop", "smart", "custom", "main", "board",
)
KEYWORDS = {
    "wifi": ("wifi", "wi-fi", "wireless internet"), "bluetooth": ("bluetooth", "ble"), "lora": ("lora", "lorawan"), "esp32": ("esp32",), "esp8266": ("esp8266",),
    "raspberry_pi": ("raspberry pi", "rpi", "raspi"), "arduino": ("arduino",), "stm32": ("stm32",),
    "battery": ("battery", "rechargeable", "lipo", "li-ion", "18650"), "usb_c": ("usb-c", "usb c", "type-c"), "solar": ("solar", "photovoltaic"),
    "display": ("display", "screen", "oled", "lcd", "led matrix", "e-ink"), "camera": ("camera", "image sensor", "webcam"), "microphone": ("microphone", "mic"),
    "speaker": ("speaker", "buzzer", "audio out"), "temperature_sensor": ("temperature", "temp sensor", "thermometer", "bme280", "dht22"),
    "humidity_sensor": ("humidity", "bme280", "dht22"), "motion_sensor": ("motion", "pir", "accelerometer", "imu", "gyro"),
    "distance_sensor": ("distance", "ultrasonic", "lidar", "tof", "tfmini"), "motor": ("motor", "servo", "stepper"), "pump": ("pump",), "fan": ("fan",),
    "rgb_led": ("rgb", "ws2812", "neopixel", "addressable led", "color led"), "remote_control": ("remote control", "ir remote", "rf remote", "handheld remote"),
    "compact": ("compact", "small", "tiny", "miniature", "portable"), "large": ("large", "big", "full-size"), "waterproof": ("waterproof", "ip67", "ip65", "weatherproof"),
}
# Fixed values of the audit: words and roles of components that cover a keyword.
COVERAGE = {
    "wifi": (("esp32", "esp8266", "wifi", "wireless"), ("wireless",)), "bluetooth": (("esp32", "bluetooth", "ble", "hm-10"), ("wireless",)),
    "lora": (("lora", "sx127", "rfm9"), ("wireless",)), "esp32": (("esp32",), ("main_controller",)), "esp8266": (("esp8266", "nodemcu", "wemos"), ("main_controller",)),
    "raspberry_pi": (("raspberry", "pi"), ("main_controller",)), "arduino": (("arduino", "uno", "nano", "mega", "atmega"), ("main_controller",)),
    "stm32": (("stm32", "bluepill"), ("main_controller",)), "battery": (("battery", "lipo", "li-ion", "18650", "cell"), ("power_source",)),
    "usb_c": (("usb-c", "usb_c", "type-c", "tp4056"), ()), "solar": (("solar", "photovoltaic", "panel"), ("power_source",)),
    "display": (("display", "screen", "oled", "lcd", "matrix", "e-ink"), ("display",)), "camera": (("camera", "cam", "imx", "ov2640"), ("sensing",)),
    "microphone": (("microphone", "mic", "inmp", "max9814"), ("sensing",)), "speaker": (("speaker", "buzzer", "piezo"), ("audio_output",)),
    "temperature_sensor": (("bme280", "bmp", "dht", "ds18b20", "temperature"), ("sensing",)), "humidity_sensor": (("bme280", "dht", "humidity", "sht"), ("sensing",)),
    "motion_sensor": (("pir", "mpu", "imu", "accelerometer", "gyro", "motion"), ("sensing",)),
    "distance_sensor": (("hc-sr04", "vl53", "lidar", "tfmini", "tof", "distance", "ultrasonic"), ("sensing",)),
    "motor": (("motor", "servo", "stepper", "nema", "dc_motor"), ("actuation",)), "pump": (("pump",), ("actuation",)), "fan": (("fan", "cooler"), ("actuation",)),
    "rgb_led": (("ws2812", "neopixel", "rgb", "apa102"), ("display",)), "remote_control": (("ir_receiver", "rf_receiver", "remote", "vs1838"), ("user_input",)),
    "compact": ((), ()), "large": ((), ()), "waterproof": ((), ()),
}
# Fixed values of repair: accessory words, what an identifier's number looks like, endings that may go.
ACCESSORIES = ("mount", "housing", "holder", "bezel", "frame", "cover", "grille", "mast", "bracket", "shell", "case", "enclosure", "panel", "stand")
NUMBERS = r"^(?i)(m\d+(?:\.\d+)?|\d+v\d*|\d+ma|\d+w|\d+mm|\d+cm|\d+s|\d+x\d+|\d+ah|\d+mah|\d+gb|\d+mhz|\d+ghz|v\d+)$"
ENDINGS = "_(module|kit|assortment|assembly|board|unit|device)$"
PLACEHOLDERS = (
    ("electrical", "electronic", "unknown", ("mcu", "controller", "esp32", "raspberry", "pixhawk", "module", "sensor", "camera", "lidar", "tfmini", "gps", "antenna", "battery", "lipo", "charger", "buck", "boost", "regulator", "display", "oled", "led", "speaker", "buzzer", "microphone", "mic", "button", "switch", "motor", "servo", "esc", "qi", "magsafe")),
    ("mechanical", "fastener", "carbon_steel", ("screw", "screws", "bolt", "nut", "washer")),
    ("mechanical", "fastener", "brass", ("standoff",)),
    ("mechanical", "3d_printed", "PLA", ("mount", "bracket", "holder", "housing", "enclosure", "frame", "panel", "cover", "shell", "hinge", "grille", "bezel", "cap", "mast")),
)
PRINT_MATERIALS = ("PLA", "PETG", "ABS", "ASA", "TPU", "NYLON", "PC")
# Fixed values of the record format: accepted words, names of phases, hints of skill, print settings patterns.
SKILL_LEVELS = ("beginner", "intermediate", "advanced", "unknown")
VARIANT_TYPES = ("seed", "prompt_rewrite", "positive_variant", "evaluation_negative")
PHASE_NAMES = {"fabricate": "fabrication", "wire": "wiring", "bringup": "bring_up", "assemble": "assembly", "test": "testing"}
BEGINNER = ("basic", "no prior", "first project")
ADVANCED = ("advanced", "rf design", "high voltage", "professional", "fpga", "rtos")
PRINT = {
    "infill_pct": r"(?i)(\d+)\s*%\s*infill", "layer_mm": r"(?i)(\d+(?:\.\d+)?)\s*mm\s*layer", "perimeters": r"(?i)(\d+)\s*perimeter",
    "nozzle_mm": r"(?i)(\d+(?:\.\d+)?)\s*mm\s*nozzle", "material_hint": r"(?i)\b(PLA|PETG|ABS|ASA|TPU|Nylon|PC)\b",
}
# The mark of a step without a body, and the least length of a body.
PLACEHOLDER = "*(not yet generated)*"
MIN_BODY = 15
# Fixed values of the record format.
#: Anchored size patterns in order: (kind, pattern, fields in the order of the groups).
DIMENSIONS = (
    ("box", r"(?i)^\s*(\d+(?:\.\d+)?)\s*[x×]\s*(\d+(?:\.\d+)?)\s*[x×]\s*(\d+(?:\.\d+)?)\s*mm\s*$", ("length_mm", "width_mm", "height_mm")),
    ("plate", r"(?i)^\s*(\d+(?:\.\d+)?)\s*[x×]\s*(\d+(?:\.\d+)?)\s*mm\s*$", ("length_mm", "width_mm")),
    ("thread_length", r"(?i)^\s*M(\d+(?:\.\d+)?)\s*[x×]\s*(\d+(?:\.\d+)?)\s*mm\s*$", ("thread", "length_mm")),
    ("thread", r"(?i)^\s*M(\d+(?:\.\d+)?)\s*$", ("thread",)),
    ("diameter", r"(?i)^\s*(\d+(?:\.\d+)?)\s*mm\s+(?:diameter|dia)\s*$", ("diameter_mm",)),
    ("tube", r"(?i)^\s*(\d+(?:\.\d+)?)\s*mm\s*ID\s*[x×]\s*(\d+(?:\.\d+)?)\s*mm\s*OD\s*[x×]\s*(\d+(?:\.\d+)?)\s*(?:mm|m)\s*L?\s*$", ("id_mm", "od_mm", "length_mm")),
    ("cylinder", r"(?i)^\s*(\d+(?:\.\d+)?)\s*mm\s*(?:dia(?:meter)?|d)\s*[x×]\s*(\d+(?:\.\d+)?)\s*mm\s*(?:length|l|long|h|height)?\s*$", ("diameter_mm", "length_mm")),
    ("cylinder_reversed", r"(?i)^\s*(\d+(?:\.\d+)?)\s*mm\s*(?:length|long|l|h|height)\s*[,x×]?\s*(\d+(?:\.\d+)?)\s*mm\s*(?:dia(?:meter)?|d)\s*$", ("length_mm", "diameter_mm")),
    ("length", r"(?i)^\s*~?\s*(\d+(?:\.\d+)?)\s*(?:mm|cm|m)\s*(?:length|long|l)?\s*$", ("length_mm",)),
)
