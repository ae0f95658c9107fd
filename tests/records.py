"""Raw configurations for the tests of the record operators."""

RAW = [
    {
        "slug": "Desk-Clock v2", "projectName": "Desk Clock", "projectDescription": None, "originalPrompt": "a desk clock with wifi and a display", "plan": "p" * 400,
        "notes": ["RTOS based"],
        "nodes": [
            {"id": "MCU-1", "name": "ESP32 Board", "type": "mcu", "quantity": "1", "estimatedCost": "6.50", "purchaseUrl": "https://shop.example/x "},
            {"id": "disp", "name": "OLED Display", "type": "display", "category": "electrical", "quantity": "a few", "dimensions": "27x27mm", "estimatedCost": "4.005", "purchaseUrl": "N/A"},
            {"id": "Disp", "name": "Second one", "type": "other", "quantity": "2", "dimensions": "6mm ID x 9mm OD x 5m L"},
            {"id": "case", "name": "Case", "type": "enclosure", "printSettings": "20% infill, 0.2mm layer, 3 perimeters, 0.4mm nozzle, Nylon", "dimensions": "400 x 40x15mm (outer)"},
            {"id": None, "name": "M3 Screw", "type": "misc", "material": "", "dimensions": "M3x12mm", "quantity": "4"},
            {"id": "s2", "name": "M3 Screw", "type": "misc", "dimensions": "110mm_Dia_x_30mm_H"},
            {"id": "plate", "name": "Plate", "type": "machined", "dimensions": "about a palm", "purchaseUrl": "http://x..."},
        ],
        "electricalConnections": [
            {"source": "MCU-1", "target": "disp", "label": "bus", "protocol": "I2C", "voltage": "3.3V", "sourcePin": "21", "targetPin": "SDA"},
            {"source": "MCU-1", "target": "nowhere", "label": "x"},
            {"source": "disp", "target": "MCU-1", "label": "only label"},
        ],
        "mechanicalConnections": [{"source": "case", "target": "plate", "label": "M3 bolts"}, {"source": "case", "target": "disp", "label": None}],
        "instructionPreamble": {"tools": ["iron"], "assumptions": ["basic soldering"]},
        "instructionSteps": [
            {"id": "fabricate", "subSteps": [{"id": None, "title": "Print it", "partIds": ["case", "ghost"], "detail": '{"summary": "Print the case in one piece.", "steps": ["slice", "print"]}'}]},
            {"id": "wire", "subSteps": [{"id": "Wire Up", "title": "Wire", "partIds": ["MCU-1", "disp"], "detail": None}, {"id": None, "title": "Check", "partIds": [], "detail": "Look at every joint twice."}]},
        ],
    },
    {"slug": "bare", "nodes": None, "instructionSteps": None, "notes": None},
    {"slug": "!!", "projectName": "", "nodes": [{"id": "a b"}, {"id": "a-b"}, {"id": "a_b"}, {"id": "a_b_2"}, {"name": "Lamp"}], "instructionSteps": [{"id": "later", "subSteps": [{"title": "only"}]}]},
]
