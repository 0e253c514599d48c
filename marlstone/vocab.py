"""Fixed values of the labelled-clip domain: letters, names, groups and attribute vocabularies."""

#: Role and scene letters.
ROLES, SCENES = "ABCDE", "abcdefghijklmnopqrstu"
#: Names of the roles and of the scenes.
ROLE_NAMES = {"A": "Family Member", "B": "Staff", "C": "Suspicious Person", "D": "Unspecified", "E": "Non-Human"}
SCENE_NAMES = {
    "a": "Vehicle Access", "b": "Dog Walking", "c": "Kid Playing", "d": "Kid Studying", "e": "Leisure Activity", "f": "Home Chores", "g": "Visitor Arrival",
    "h": "Package Brought Home", "i": "Package Delivery", "j": "Person Falling", "k": "Leaving Porch", "l": "Approaching Porch", "m": "Other Normal Activity",
    "n": "Package Taken Away", "o": "Other Property Damage", "p": "Wildlife", "q": "Weapon Threat", "r": "Other Hazards", "s": "Loitering", "t": "Vehicle Anomaly", "u": "Unauthorized Entry",
}
#: The parent group of the scenes.
GROUPS = {"Normal": "abcdefghijklm", "PropDmg": "no", "LifeThreat": "pqr", "Loiter": "s", "VehAnom": "t", "UnauthEntry": "u"}
#: Scenes that can't go with a role.
ILLEGAL = {"E": "bcdghjkl", "A": "nu", "D": "q"}
#: Scenes whose recall is reported, and scenes that a guard escalates; they differ on purpose.
SAFETY_REPORTED, SAFETY_GUARDED = "qrunj", "nqru"
#: Pairs that are often confused.
HOT_SCENES, HOT_ROLES = (("h", "n"), ("k", "l"), ("s", "m")), (("C", "D"), ("A", "D"))
#: The attributes and their values; the place of a value is its index.
ATTRIBUTES = {
    "clothing": ["uniform", "casual", "reflective", "not_applicable"],
    "held_items": ["package", "tool", "weapon", "leash", "none", "other"],
    "posture": ["standing", "walking", "bending", "sitting", "running", "not_applicable"],
    "action": ["walking", "lingering", "falling", "climbing", "placing_item", "taking_item", "playing", "working", "none"],
    "view_type": ["doorbell", "non_doorbell"],
    "sub_role_type": ["Kid", "Elder", "OtherFamily", "DeliveryPerson", "Police", "ServiceWorker", "Passerby", "Unknown", "NotApplicable"],
    "dwell": ["passes_through", "brief_stop", "prolonged_stay"],
}
#: Section tags and what they are normalised to.
TAGS = {"[身份线索]": "[Identity cues]", "[场景线索]": "[Scene cues]", "[结论]": "[Conclusion]"}
#: Fixed value: index of a value that is to be ignored.
IGNORED = -100
#: Fixed value: what Python's str.strip cuts and str.split splits at, inside a character class of Java or RE2.
WHITE = r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
