"""Word lists, patterns and scores that results depend on. Patterns are in Java syntax.

(?U) makes the classes and word boundaries Unicode ones.
"""

from __future__ import annotations

EMAIL = r"(?U)[\w\.-]+@[\w\.-]+\.\w+"
PHONE = r"(?U)(?:\+\d{1,3}[-.\s]\d{3,4}[-.\s]\d{3,8}|\(?\d{3}\)?[-.\s]\d{3,4}[-.\s]\d{4})"
COMPANY_KEYWORDS = ["llc", "inc", "corp", "corporation", "ltd", "gmbh", "sa", "plc", "company", "co.", "industries", "technologies", "systems", "labs", "medical", "solutions", "group", "holdings", "partners"]
TITLES = "Mr|Mrs|Ms|Dr|Prof|CEO|COO|CTO|CFO|VP|Director|Manager|Engineer"
TITLED_PERSON = rf"(?U)(?:{TITLES})[.\s]+([A-Z][a-z]+)\s+([A-Z][a-z]+)"

US_STATES = "Alabama|Alaska|Arizona|Arkansas|California|Colorado|Connecticut|Delaware|Florida|Georgia|Hawaii|Idaho|Illinois|Indiana|Iowa|Kansas|Kentucky|Louisiana|Maine|Maryland|Massachusetts|Michigan|Minnesota|Mississippi|Missouri|Montana|Nebraska|Nevada|New Hampshire|New Jersey|New Mexico|New York|North Carolina|North Dakota|Ohio|Oklahoma|Oregon|Pennsylvania|Rhode Island|South Carolina|South Dakota|Tennessee|Texas|Utah|Vermont|Virginia|Washington|West Virginia|Wisconsin|Wyoming"
COUNTRIES = "United States|USA|America|China|Japan|Germany|France|United Kingdom|UK|Canada|Australia|India|Brazil|Mexico|Italy|Spain|Korea|Hong Kong|Singapore|Switzerland|Netherlands|Sweden|Norway|Denmark|Finland|Belgium|Austria|Ireland|Portugal|Greece|Turkey|Russia|South Africa|Argentina|Chile|Colombia"
COUNTRIES_CN = "中国|美国|日本|德国|法国|英国|加拿大|澳大利亚|印度|巴西|墨西哥|意大利|西班牙|韩国|香港|新加坡|瑞士|荷兰|瑞典|挪威|丹麦|芬兰|比利时|奥地利|爱尔兰|葡萄牙|希腊|土耳其|俄罗斯|南非|阿根廷|智利|哥伦比亚"
PROVINCES_CN = "北京|上海|天津|重庆|河北|山西|辽宁|吉林|黑龙江|江苏|浙江|安徽|福建|江西|山东|河南|湖北|湖南|广东|海南|四川|贵州|云南|陕西|甘肃|青海|台湾|内蒙古|广西|西藏|宁夏|新疆|香港|澳门"
CITIES_CN = "北京|上海|广州|深圳|杭州|南京|成都|重庆|武汉|西安|长沙|郑州|济南|青岛|大连|沈阳|哈尔滨|长春|昆明|贵阳|南宁|福州|厦门|南昌|合肥|石家庄|太原|兰州|银川|西宁|乌鲁木齐|拉萨|呼和浩特|海口|三亚|东莞|佛山|苏州|无锡|常州|南通|徐州|扬州|镇江|泰州|盐城|淮安|宿迁|连云港|温州|宁波|绍兴|嘉兴|湖州|金华|衢州|舟山|台州|丽水"
LOCATIONS = [rf"(?U)\b(?:{US_STATES})\b", rf"(?U)\b(?:{COUNTRIES})\b", f"(?:{COUNTRIES_CN})", f"(?:{PROVINCES_CN})", f"(?:{CITIES_CN})", r"(?U)\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+,?\s+(?:[A-Z]{2}|\w+)\b"]
US_ZIP = r"(?U)\b\d{5}(?:-\d{4})?\b"
CN_ZIP = r"(?U)\b\d{6}\b"
CN_ADDRESS = r"(?U)(?:[^\s]{2,10}(?:省|市|区|县|镇|乡|村|路|街|大道|巷|弄|号|室|楼|栋|座|层|楼|单元))"
EN_ADDRESS = r"(?iuU)\b\d+\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+(?:St|St|Ave|Blvd|Dr|Ln|Rd|Way|Pl|Ct|Ter|Cir)\.?\b"
SENSITIVE_DOC_TYPES = ["nda", "non-disclosure", "confidential", "invoice", "quotation", "proposal", "contract", "salary", "payment", "receipt"]

PERSON_PATTERNS = [
    r"(?U)(?:Mr|Mrs|Ms|Miss|Dr|Prof|Professor|CEO|COO|CTO|CFO|VP|Director|Manager|Engineer|President)[.:\s]+([A-Z][a-z]+)\s+([A-Z][a-z]+)",
    r"(?U)([A-Z][a-z]+)\s+([A-Z][a-z]+),\s+(?:CEO|COO|CTO|CFO|VP|Director|Manager|Engineer|President|Owner|Founder)",
    r"(?U)\bby\s+([A-Z][a-z]+)\s+([A-Z][a-z]+)\b",
    r"(?U)([A-Z][a-z]+)\s+([A-Z][a-z]+)\s+<[\w.+-]+@[\w.-]+>",
]
TITLES_CN = "先生|女士|小姐|博士|教授|经理|总监|总裁|总经理"
SURNAMES_CN = (
    "赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许何吕施张孔曹严华金魏陶姜"
    "戚谢邹喻柏水窦章云苏潘葛奚范彭郎鲁韦昌马苗凤花方俞任袁柳酆鲍史唐费"
    "廉岑薛雷贺倪汤滕殷罗毕郝邬安常乐于时傅皮卞齐康伍余元卜顾孟平黄和穆"
    "萧尹姚邵湛汪祁毛禹狄米贝明臧计伏成戴谈宋茅庞熊纪舒屈项祝董梁杜阮蓝"
    "闵席季麻强贾路娄危江童颜郭梅盛林刁钟徐邱骆高夏蔡田樊胡凌霍虞万支柯"
    "昝管卢莫经房裘缪干解应宗丁宣贲邓郁单杭洪包诸左石崔吉钮龚程嵇邢滑裴"
    "陆荣翁荀羊於惠甄曲家封芮羿储靳汲邴糜松井段富巫乌焦巴弓牧隗山谷车侯"
    "宓蓬全郗班仰秋仲伊宫宁仇栾暴甘钭厉戎祖武符刘景詹束龙叶幸司韶郜黎蓟"
    "薄印宿白怀蒲邰从鄂索咸籍赖卓蔺屠蒙池乔阴胥能苍双温庄晏瞿蛮充慕连茹"
    "习宦艾鱼容向古易慎戈廖庾终暨居衡步都耿满弘匡国文寇广禄阙东欧殳沃利"
    "蔚越夔隆师巩厍聂晁勾敖融冷訾辛阚那简饶空曾毋沙乜养鞠须丰巢关蒯相查"
    "后荆红游竺权逯盖益桓公"
)
SURNAME_CN = rf"(?U)(?:{TITLES_CN})[\s:]*([{SURNAMES_CN}])"
ORG_WORDS = [
    "company", "corporation", "corporate", "inc", "incorporated", "llc", "ltd", "limited", "gmbh", "ag", "sa", "plc", "nv", "bv",
    "technologies", "technology", "industries", "industry", "solutions", "systems", "labs", "laboratories", "medical", "engineering",
    "group", "groups", "holdings", "partners", "partnership", "consulting", "services", "service", "international", "global",
]
PARTNERS = r"(?U)([A-Z][A-Za-z]+)\s+&\s+([A-Z][A-Za-z]+)"
NAME_OF_NAME = r"(?U)([A-Z][A-Za-z]+\s+of\s+[A-Z][A-Za-z]+)"
PRODUCT_PATTERNS = [
    r"(?iuU)(?:model|mod|mdl)[\s:-]*([A-Z0-9][-0-9A-Z]{2,10})",
    r"(?iuU)(?:part\s*(?:no|number)\.?|p/n|pn)[\s:]*([A-Z0-9][-0-9A-Z.]{2,20})",
    r"(?iuU)(?:serial\s*(?:no|number)\.?|s/n|sn)[\s:]*([A-Z0-9][-0-9A-Z.]{2,20})",
    r"(?iuU)([A-Z][A-Za-z0-9]+)\s+v(\d+\.\d+(?:\.\d+)?)",
]

FILENAME_PATTERNS = [
    ("email", EMAIL, 0.95),
    ("phone", PHONE, 0.85),
    ("person_name", r"(?U)\b([A-Z][a-z]+ [A-Z][a-z]+)\b", 0.6),
    ("date", r"(?U)\b(20\d{2}[-./]\d{1,2}[-./]\d{1,2})\b", 0.5),
    ("invoice_number", r"(?iuU)\b(INV|PO|PR|SO)[-#]?\d{4,}\b", 0.75),
    ("part_number", r"(?iuU)\b[P/N|PN|P/N][:.]?\s*[\w-]{3,}\b", 0.7),
]
DEFAULT_CONFIDENCE = 0.5

EXTENSIONS = {
    "image": [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".svg", ".webp", ".tiff", ".tif", ".ico", ".heic", ".heif", ".raw", ".cr2"],
    "video": [".mp4", ".avi", ".mov", ".mkv", ".wmv", ".flv", ".webm", ".m4v", ".mpg", ".mpeg", ".3gp"],
    "audio": [".mp3", ".wav", ".flac", ".aac", ".ogg", ".wma", ".m4a"],
    "document": [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".txt", ".rtf", ".odt", ".ods", ".odp", ".csv", ".tsv"],
    "cad": [".step", ".stp", ".stl", ".obj", ".fbx", ".blend", ".dwg", ".dxf", ".sldprt", ".sldasm", ".ipt", ".iam", ".prt", ".asm", ".x_t", ".x_b", ".iges", ".igs"],
    "electronics": [".brd", ".sch", ".pcb", ".kicad_pcb", ".kicad_sch", ".fzz", ".hex", ".bin", ".elf"],
    "archive": [".zip", ".tar", ".gz", ".bz2", ".7z", ".rar", ".xz"],
    "firmware": [".hex", ".bin", ".elf", ".fw", ".uif", ".dfu"],
    "code": [".py", ".js", ".c", ".cpp", ".h", ".java", ".go", ".rs", ".html", ".css", ".json", ".xml", ".yaml", ".yml", ".toml"],
}
CLEANER_EXTENSIONS = {
    "text": [".txt", ".csv", ".tsv", ".log", ".md", ".rst", ".py", ".js", ".c", ".cpp", ".h", ".java", ".go", ".rs", ".html", ".css", ".json", ".xml", ".yaml", ".yml", ".toml", ".sql", ".sh", ".bash", ".zsh"],
    "pdf": [".pdf"],
    "image": [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".tif", ".webp", ".heic", ".heif"],
    "audio": [".mp3", ".wav", ".flac", ".aac", ".ogg", ".wma", ".m4a"],
    "video": [".mp4", ".avi", ".mov", ".mkv", ".wmv", ".flv", ".webm", ".m4v", ".mpg", ".mpeg", ".3gp"],
    "xlsx": [".xlsx", ".xlsm"],
    "docx": [".docx"],
}
PREFIXES = {"person": "PERSON", "company": "COMPANY", "location": "LOCATION", "email": "EMAIL", "phone": "PHONE", "address": "ADDRESS", "sensitive_doc": "DOCREF"}
DEFAULT_PREFIX = "ENTITY"

DOC_KEYWORDS = r"(?iuU)(invoice|quotation|proposal|quote|contract|agreement|receipt|payment|paid|confidential|nda|non-disclosure|report|specification|bom|bill\s*of\s*materials|resume|cv|salary|passport|id\s*card|license)"
HEAVY_KEYWORDS = ["confidential", "nda", "non-disclosure"]
SENSITIVE_NAMES = [
    "invoice_2020.pdf", "invoice_acme_march.pdf", "INV-12345.pdf", "quotation_v2.pdf", "quote_response.pdf", "payment_receipt_jan.png",
    "payment_confirmation.pdf", "receipt_001.jpg", "paid_invoice.pdf", "budget_2021.xlsx", "financial_report_q4.pdf",
    "tax_filing_2020.pdf", "vat_return.pdf", "purchase_order_1001.pdf", "PO-5432.pdf", "nda_acme_signed.pdf",
    "non-disclosure_agreement.pdf", "contract_v3.pdf", "service_agreement.pdf", "confidential_strategy.pdf", "proprietary_design.pdf",
    "license_agreement.pdf", "terms_of_service.pdf", "resume_john_doe.pdf", "cv_smith.pdf", "employee_handbook.pdf", "salary_review.xlsx",
    "performance_review_2020.pdf", "passport_scan.jpg", "id_card_front.png", "driver_license.jpg", "ssn_form.pdf", "bom_revision3.xlsx",
    "bill_of_materials.pdf", "prototype_design.pdf", "specification_v2.pdf", "roadmap_2021.pdf", "strategy_deck.pptx",
]
NORMAL_NAMES = [
    "photo_001.jpg", "screenshot.png", "image_123.bmp", "vacation_photo.jpg", "family_pic.png", "readme.txt", "changelog.md", "todo.txt",
    "test_results.log", "build_output.txt", "meeting_notes.pdf", "agenda.pdf", "minutes.docx", "presentation.pptx", "draft.docx",
    "part_001.step", "assembly.dxf", "board_rev2.sch", "firmware.hex", "config.json",
]

STEP_FIELDS = [("product", "PRODUCT"), ("description", "DESCRIPTION"), ("directory", "DIRECTORY"), ("designer", "DESIGNER"), ("organization", "ORGANIZATION"), ("time", "TIME_TIMESTAMP")]
DXF_KEYS = ["ACAD_MAINTVER", "ACAD_VER", "DWGCODEPAGE", "INSBASE", "EXTMIN", "EXTMAX", "LIMMIN", "LIMMAX", "AUTHOR", "LAST_SAVED_BY", "COMPANY", "COMMENT"]
EAGLE_TAGS = ["name", "value", "description", "author", "date", "revision", "company"]
GERBER_FORMAT = r"(?U)%FSLA\w+(\d+)Y(\d+)E*%"
GERBER_TICKET = r"(?s)SLDR\+(.*?)SLDR-"
SENSITIVE_METADATA = ["author", "last_saved_by", "company", "designer", "organization", "manager", "comments"]
PLACEHOLDER = r"(?U)\[\w+_\d{3,}\]"
STRICT_PLACEHOLDER = r"\[[A-Z]+_\d{3,}\]"

#: Labels that a model for entities is asked for, and the kinds of those that are kept.
ASKED_LABELS = ["person", "organization", "email", "phone", "address", "invoice", "date", "money"]
MODEL_LABELS = {"person": "person", "organization": "company"}
